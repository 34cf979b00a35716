"""Language of every word by a linear-chain conditional random field, and of a text by its words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapwise.llm.drawing import drawn_number, share

# Learned from about so many documents of each language, and of each document
# from so many consecutive words at a place drawn by a hash; where there are many languages, from fewer
# documents of each, about so many together.
DOCS_PER_LANGUAGE = 300
SAMPLE_DOCS = 19_200
WORDS_PER_DOC = 80
LEXICON = 300
GRAMS = 1 << 16
EPOCHS = 12
SEQUENCES_AT_ONCE = 64
RATE = 0.5
SEED = 5
HELD_OUT_FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
# Longer words, as a sentence in a script without spaces, are cut into words of so many characters and a rest.
LONGEST = 64
SLICE_CHARS = 1_000_000
_BEGIN, _END = "\x02", "\x03"


def held_out(doc_id: str = "doc_id", folds: int = HELD_OUT_FOLDS, fold: int = HELD_OUT) -> Column:
    """A null doc_id is in no fold to learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(True))


def grams(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character 2- to 4-grams of all words in turn, and how many each word has.

    Words are marked at both ends, so grams at a mark are its affixes of one to three letters.
    """
    points = np.frombuffer(
        "".join(f"{_BEGIN}{word}{_END}" for word in words).encode("utf-32-le", "surrogatepass"), "<u4"
    ).astype(np.uint32)
    size = np.array([len(word) + 2 for word in words], np.int64)
    ends = np.repeat(np.cumsum(size), size)
    place = np.arange(len(points))
    word = np.repeat(np.arange(len(words)), size)
    codes, owners = [], []
    mixed = points * np.uint32(0x9E3779B1)
    for n, factor in ((2, 0x85EBCA6B), (3, 0xC2B2AE35), (4, 0x27D4EB2F)):
        mixed = (mixed[: len(points) - n + 1] ^ points[n - 1 :]) * np.uint32(factor)
        mixed ^= mixed >> np.uint32(15)
        inside = place[: len(mixed)] + n <= ends[: len(mixed)]
        codes.append(mixed[inside] & np.uint32(GRAMS - 1))
        owners.append(word[: len(mixed)][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(codes)[order].astype(np.int64), np.bincount(owner, minlength=len(words))


@dataclass(frozen=True)
class Field:
    """Languages, the lexicon's rows, and the learned weights."""

    languages: list[str]
    lexicon: dict[str, int]
    weights: np.ndarray  # of grams, then of the lexicon's words; by language
    moves: np.ndarray
    start: np.ndarray

    def emissions(self, words: Sequence[str]) -> np.ndarray:
        """A word's score by language: the mean weight of its grams, and its lexicon entry's."""
        codes, size = grams(words)
        begin = np.cumsum(size) - size
        scores = np.add.reduceat(self.weights[codes], begin, axis=0) / size[:, None]
        listed = [(i, row) for i, word in enumerate(words) if (row := self.lexicon.get(word)) is not None]
        if listed:
            at, rows = np.array(listed).T
            scores[at] += self.weights[GRAMS + rows]
        return scores


def posteriors(
    emissions: np.ndarray, begins: np.ndarray, moves: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Every word's label probabilities by forward-backward, and the expected number of each move.

    Words of all sequences stand in turn; `begins` marks the first of each, where nothing carries over. To
    take as few steps as possible, the run is cut into about sqrt(n) parts: first the product of
    the steps of all parts at once, then forward and backward messages from part to part, then
    within all parts at once. The result is that of one pass over the whole.
    """
    n, k = emissions.shape
    steps = max(1, int(np.ceil(np.sqrt(n))))
    parts = -(-n // steps)
    fill = parts * steps - n
    e = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    e = np.vstack([e, np.ones((fill, k))]).reshape(parts, steps, k)
    first = np.append(begins, np.ones(fill, bool)).reshape(parts, steps)
    real = np.append(np.ones(n, bool), np.zeros(fill, bool)).reshape(parts, steps)
    x, s = np.exp(moves), np.exp(start)

    whole = np.broadcast_to(np.eye(k), (parts, k, k)).copy()
    for t in range(steps):
        fresh = whole.sum(axis=2)[:, :, None] * s
        whole = np.where(first[:, t, None, None], fresh, whole @ x) * e[:, t, None, :]
        whole /= whole.sum(axis=(1, 2), keepdims=True)
    into, out = np.ones((parts, k)), np.ones((parts, k))
    for c in range(1, parts):
        into[c] = into[c - 1] @ whole[c - 1]
        into[c] /= into[c].sum()
    for c in range(parts - 2, -1, -1):
        out[c] = whole[c + 1] @ out[c + 1]
        out[c] /= out[c].sum()

    ahead, now = np.empty_like(e), into
    for t in range(steps):
        now = np.where(first[:, t, None], now.sum(axis=1, keepdims=True) * s, now @ x) * e[:, t]
        now /= now.sum(axis=1, keepdims=True)
        ahead[:, t] = now
    found, expected, now = np.empty_like(e), np.zeros((k, k)), out
    for t in range(steps - 1, -1, -1):
        both = ahead[:, t] * now
        found[:, t] = both / both.sum(axis=1, keepdims=True)
        before = ahead[:, t - 1] if t else into
        weight = e[:, t] * now
        carried = ~first[:, t] & real[:, t]
        if carried.any():
            pair = before[carried][:, :, None] * x * weight[carried][:, None, :]
            expected += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        now = np.where(first[:, t, None], 1.0, weight @ x.T)
        now /= now.sum(axis=1, keepdims=True)
    return found.reshape(-1, k)[:n], expected


def words_of(text: str | None) -> list[str]:
    words = (text or "").lower().split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [word[at : at + LONGEST] for word in words for at in range(0, len(word), LONGEST)]


def fit(sample: list[tuple[str, list[str]]]) -> Field:
    """Weights and transitions by gradient steps on the likelihood of the samples' word labels.

    Beside each sample of one language stands one whose second half comes from another sample, so that
    moves from language to language are seen, as in code-switched text.
    """
    languages = sorted({language for language, _ in sample})
    number = {language: i for i, language in enumerate(languages)}
    k = len(languages)
    frequent: dict[str, int] = {}
    for language in languages:
        counts = Counter(word for own, words in sample if own == language for word in words)
        for word, _ in sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:LEXICON]:
            frequent.setdefault(word, len(frequent))
    rng = np.random.default_rng(SEED)
    sequences = [(words, [number[language]] * len(words)) for language, words in sample if words]
    for (a, a_labels), other in zip(list(sequences), rng.permutation(len(sequences))):
        b, b_labels = sequences[other]
        half_a, half_b = (len(a) + 1) // 2, len(b) // 2
        sequences.append((a[:half_a] + b[half_b:], a_labels[:half_a] + b_labels[half_b:]))
    weights = np.zeros((GRAMS + len(frequent), k))
    moves, start = np.zeros((k, k)), np.zeros(k)
    squares = [np.full_like(p, 1e-6) for p in (weights, moves, start)]
    for epoch in range(EPOCHS):
        order = rng.permutation(len(sequences))
        for at in range(0, len(order), SEQUENCES_AT_ONCE):
            chosen = [sequences[i] for i in order[at : at + SEQUENCES_AT_ONCE]]
            words = [word for own, _ in chosen for word in own]
            labels = np.array([label for _, own in chosen for label in own])
            size = np.array([len(own) for own, _ in chosen])
            begins = np.zeros(len(words), bool)
            begins[np.cumsum(size) - size] = True
            field = Field(languages, frequent, weights, moves, start)
            found, expected = posteriors(field.emissions(words), begins, moves, start)
            missing = np.eye(k)[labels] - found
            codes, per_word = grams(words)
            pull = np.zeros_like(weights)
            spread = np.repeat(missing / per_word[:, None], per_word, axis=0)
            for label in range(k):
                pull[:GRAMS, label] = np.bincount(codes, spread[:, label], minlength=GRAMS)
            listed = np.array([frequent.get(word, -1) for word in words])
            np.add.at(pull, GRAMS + listed[listed >= 0], missing[listed >= 0])
            seen = np.zeros((k, k))
            np.add.at(seen, (labels[:-1][~begins[1:]], labels[1:][~begins[1:]]), 1)
            for value, square, step in zip((weights, moves, start), squares, (pull, seen - expected, missing[begins].sum(axis=0))):
                step = step / len(chosen)
                square += step**2
                value += RATE * step / np.sqrt(square)
    return Field(languages, frequent, weights.astype(np.float32), moves, start)


def learn(
    docs: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    words_per_doc: int = WORDS_PER_DOC,
    sample_docs: int = SAMPLE_DOCS,
) -> Field | None:
    """The field, from a sample of `docs` (doc_id, text, lang) that are not held out; none if none has a language.

    Every value of lang gives about `docs_per_language` documents, or an equal part of `sample_docs` if that
    is less, drawn by a hash of doc_id and text, and each of them `words_per_doc` words from a drawn place on.
    Rows that share both are one.
    """
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    most = min(docs_per_language, max(1, sample_docs // max(1, len(sizes))))
    shares = [(row["lang"], share(row["n"], most)) for row in sizes]
    # As many rows as the field has languages.
    shares = docs.sparkSession.createDataFrame(shares, T.StructType([known.schema["lang"], T.StructField("_share", T.LongType())]))
    drawn = known.select("doc_id", "text", "lang").join(F.broadcast(shares), "lang").where(
        drawn_number("language", "doc_id", "text") < F.col("_share")
    )
    words = drawn.select("doc_id", "lang", F.regexp_extract_all(F.lower("text"), F.lit(rf"(?U)\S{{1,{LONGEST}}}"), F.lit(0)).alias("words"))
    places = F.greatest(F.size("words") - words_per_doc, F.lit(0)) + 1
    place = F.pmod(F.xxhash64(F.lit("place"), "doc_id"), places).cast("int") + 1
    cut = words.where(F.size("words") > 0).select("doc_id", "lang", F.slice("words", place, words_per_doc).alias("words"))
    rows = sorted((row["lang"], row["doc_id"], row["words"]) for row in cut.distinct().collect())
    return fit([(lang, own) for lang, _, own in rows]) if rows else None


def label_words(text: str | None, field: Field) -> list[tuple[str, str, float]]:
    """(word, its likeliest language, that one's probability) of every word of one text."""
    words = words_of(text)
    if not words:
        return []
    begins = np.zeros(len(words), bool)
    begins[0] = True
    found, _ = posteriors(field.emissions(words), begins, field.moves, field.start)
    best = found.argmax(axis=1)
    return [(w, field.languages[b], float(found[i, b])) for i, (w, b) in enumerate(zip(words, best))]


def text_languages(texts: Sequence[str | None], field: Field) -> list[tuple[str, float]]:
    """Each text's language and the share of its words' probability that it has; words without letters don't count."""
    owned = [words_of(text) for text in texts]
    size = np.array([len(own) for own in owned], np.int64)
    words = [word for own in owned for word in own]
    if not words:
        return [(UNKNOWN, 0.0)] * len(texts)
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}
    place = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    lettered = np.array([any(map(str.isalpha, word)) for word in number], bool)
    full = np.flatnonzero(size)
    starts = (np.cumsum(size) - size)[full]
    begins = np.zeros(len(words), bool)
    begins[starts] = True
    found, _ = posteriors(field.emissions(list(number))[place], begins, field.moves, field.start)
    sums = np.add.reduceat(found * lettered[place][:, None], starts, axis=0)
    result = [(UNKNOWN, 0.0)] * len(texts)
    for i, row in zip(full, sums):
        total = row.sum()
        if total > 0:
            result[i] = (field.languages[row.argmax()], float(min(1.0, row.max() / total)))
    return result


def identify(docs: DataFrame, field: Field | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of `docs` with the language found and its score, from every word of every text.

    A text that is null, empty or without letters has no language: `und`, score 0; so has every text if
    nothing was learned. Ties go to the language first by name. Repeated rows are labelled each; an
    empty table gives no rows. Columns of `docs` called like one of `names` are replaced.
    """
    docs = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    # What is held of a slice grows with the number of languages.
    slice_chars = SLICE_CHARS * 16 // max(16, len(field.languages) if field else 0)
    place = docs.columns.index("text")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found: list[tuple[str, float]] = []
            first, chars = 0, 0
            for i, text in enumerate(texts):
                chars += len(text or "")
                if chars > slice_chars or i == len(texts) - 1:
                    part = texts[first : i + 1]
                    found += text_languages(part, shared.value) if shared.value else [(UNKNOWN, 0.0)] * len(part)
                    first, chars = i + 1, 0
            columns = [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(label, schema)
