"""Byte-level BPE: chunks are cut into pre-tokens in parallel, stitched where their bounds meet, then encoded."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A text is cut into chunks that begin so many characters apart, and reach so far into the next one.
CHUNK_CHARS = 65_536
OVERLAP_CHARS = 1_024
# A pre-token that ends so far before a chunk's end, or farther, is not changed by what follows.
MARGIN_CHARS = 3
# Pre-tokens whose ids a worker remembers.
KNOWN_PIECES = 300_000
KNOWN_CHARS = 40
# Ids of so many characters are handed on at once.
SLICE_CHARS = 2_000_000

ENCODED = "row long, doc_id long, piece int, ids binary"
DIGESTED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_CHUNK = "row long, doc_id long, chunk int, start long, last boolean, text string"
_SCANNED = _CHUNK + ", ends binary"
_PIECE = "row long, doc_id long, piece int, text string, ends binary"


class _Known(dict):
    """Ids by pre-token, worked out when they are first asked for."""

    def __init__(self, encode: Callable[[str], list[int]]):
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encode(piece), "<u4").tobytes()
        if len(self) < KNOWN_PIECES and len(piece) <= KNOWN_CHARS:
            self[piece] = ids
        return ids


class Vocabulary:
    """Ranks and a pattern of pre-tokens, in a worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        coding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # Of one pre-token, so that a long run of white space, on which the library's own splitting fails, is one too.
        self.known = _Known(coding._encode_single_piece)
        self.token = {rank: token for token, rank in ranks.items()}
        self.number = {rank: str(rank) for rank in ranks.values()}
        self.pattern = regex.compile(pattern)
        self.odd = _stand_ins()
        # Quick to rule out: any character from the first odd one on.
        self.maybe_odd = regex.compile(f"[{chr(min(self.odd))}-\U0010ffff]" if self.odd else "(?!)")

    def scanned(self, text: str) -> str:
        """`text` as the pattern is to see it: of the same length, and with the bounds that tiktoken would find."""
        return text.translate(self.odd) if self.maybe_odd.search(text) else text

    def pre_tokens(self, text: str) -> list[str]:
        seen = self.scanned(text)
        if seen is text or seen == text:
            return self.pattern.findall(text)
        return cut(text, [match.end() for match in self.pattern.finditer(seen)])

    def ends(self, text: str) -> np.ndarray:
        """Where each pre-token ends; they lie one after another."""
        return np.array([match.end() for match in self.pattern.finditer(self.scanned(text))], "<i4")

    def encode(self, pieces: list[str]) -> bytes:
        return b"".join(map(self.known.__getitem__, pieces))


@cache
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """This worker's vocabulary."""
    return Vocabulary(path, pattern)


@cache
def _stand_ins() -> dict[int, int]:
    """For characters that `regex` and tiktoken put into different classes, as they know different versions of
    Unicode, characters that both put where tiktoken has those."""
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    ranks = {bytes([b]): b for b in range(256)}
    odd, kind = set(), {}
    for name, example in ((r"\p{L}", "a"), (r"\p{N}", "1"), (r"\s", " ")):
        coding = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=ranks, special_tokens={})
        has = set(bytes(coding.encode_ordinary(every)).decode())
        odd |= has ^ set(regex.findall(name, every))
        kind |= dict.fromkeys(has, example)
    return {ord(c): ord(kind.get(c, ".")) for c in odd}


def cut(text: str, ends: list[int]) -> list[str]:
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _rows(batch: pa.RecordBatch, most_chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """The batch's rows, in slices of some `most_chars` of text, or of one row."""
    if not batch.num_rows:
        return
    size = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most_chars, "right")))
        yield batch.slice(at, end - at)
        at = end


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(", "))])


def _cut_chunks(chunk_chars: int, overlap: int):
    schema = _schema(_CHUNK)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _rows(batch, 1):
                (row,), (doc_id,), (text,) = (part.column(c).to_pylist() for c in ("row", "doc_id", "text"))
                for chunk, start in enumerate(range(0, len(text), chunk_chars)):
                    end = start + chunk_chars
                    yield _batch(schema, [(row, doc_id, chunk, start, end >= len(text), text[start : end + overlap])])

    return chunks


def _scan_chunks(path: str, pattern: str):
    schema = _schema(_SCANNED)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in batches:
            for part in _rows(batch):
                found = []
                for row in part.to_pylist():
                    ends = words.ends(row["text"])
                    if not row["last"]:
                        ends = ends[ends <= len(row["text"]) - MARGIN_CHARS]
                    found.append((*row.values(), ends.tobytes()))
                yield _batch(schema, found)

    return scan


class Stitcher:
    """Joins the chunks of one text, given in order, at bounds that are true.

    What follows a bound depends on nothing before it. So where the bounds found from the text's beginning
    (`at` is the last of them) meet those of a chunk, the chunk's bounds are true from there on. Should
    they not meet within the overlap, the text is scanned on from `at` until they do; nothing but the text
    since `at` is held for that.
    """

    def __init__(self, ends_of: Callable[[str], Iterator[int]]):
        self.ends_of = ends_of
        self.at, self.held = 0, ""

    def add(self, start: int, text: str, ends: np.ndarray, last: bool) -> Iterator[tuple[str, list[int]]]:
        """The pre-tokens that have become known: their text, and where in it each ends."""
        covered = self.at + len(self.held)
        held = self.held + text[covered - start :] if covered < start + len(text) else self.held
        bounds = ends.astype(np.int64) + start
        found: list[int] = []
        at = self.at
        if len(bounds) or last:
            known = {start, *bounds.tolist()}
            if at not in known:
                trusted = self.at + len(held) - (0 if last else MARGIN_CHARS)
                for end in self.ends_of(held):
                    if self.at + end > trusted:
                        break
                    found.append(end)
                    at = self.at + end
                    if at in known:
                        break
            if at in known:
                found += (bounds[bounds > at] - self.at).tolist()
        if found:
            yield held[: found[-1]], found
            self.at += found[-1]
            held = held[found[-1] :]
        self.held = held


def _stitch_chunks(path: str, pattern: str):
    schema = _schema(_PIECE)

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)

        def ends_of(text: str) -> Iterator[int]:
            return (match.end() for match in words.pattern.finditer(words.scanned(text)))

        now, piece, stitcher = None, 0, None
        for batch in batches:
            for part in _rows(batch):
                found = []
                for r in part.to_pylist():
                    if r["row"] != now:
                        now, piece, stitcher = r["row"], 0, Stitcher(ends_of)
                    for text, ends in stitcher.add(r["start"], r["text"], np.frombuffer(r["ends"], "<i4"), r["last"]):
                        found.append((now, r["doc_id"], piece, text, np.array(ends, "<i4").tobytes()))
                        piece += 1
                yield _batch(schema, found)

    return stitch


def _encode_pieces(path: str, pattern: str):
    """Ids of rows of text; where a row says how its pre-tokens end, it is cut there."""
    schema = _schema(ENCODED)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in batches:
            for part in _rows(batch):
                texts = [text or "" for text in part.column("text").to_pylist()]
                if "ends" in part.schema.names:
                    ends = [np.frombuffer(e, "<i4").tolist() for e in part.column("ends").to_pylist()]
                    pieces = map(cut, texts, ends)
                else:
                    pieces = map(words.pre_tokens, texts)
                ids = pa.array([words.encode(own) for own in pieces], pa.binary())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in schema.names[:3]], ids], schema=schema)

    return encode


def _decode_pieces(path: str, pattern: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = vocabulary(path, pattern).token
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [np.frombuffer(own, "<u4").tolist() for own in part.column("ids").to_pylist()]
                raw = pa.array([b"".join(map(token.__getitem__, own)) for own in ids], pa.binary())
                yield part.append_column("decoded", raw)

    return decode


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _whole_texts(docs: DataFrame, chunk_chars: int) -> DataFrame:
    short = F.coalesce(F.length("text") <= chunk_chars, F.lit(True))
    return _texts(docs).where(short).select("row", "doc_id", F.lit(0).alias("piece"), "text")


def _stitched(docs: DataFrame, path: str, pattern: str, chunk_chars: int, overlap: int) -> DataFrame:
    longer = _texts(docs).where(F.length("text") > chunk_chars)
    chunks = longer.mapInArrow(_cut_chunks(chunk_chars, overlap), _CHUNK).repartition("row", "chunk")
    scanned = chunks.mapInArrow(_scan_chunks(path, pattern), _SCANNED)
    placed = scanned.repartition("row").sortWithinPartitions("row", "chunk")
    return placed.mapInArrow(_stitch_chunks(path, pattern), _PIECE).repartition("row", "piece")


def encode(
    docs: DataFrame, path: str, pattern: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> DataFrame:
    """Each text's ids by the ranks in the file at `path`: `row`, `doc_id`, `piece`, `ids`.

    Every match of `pattern` is encoded by itself, as tiktoken does, without special tokens. `row` is one for each row
    of `docs`, whose ids are those of its pieces in turn (from 0), as unsigned 32-bit little-endian numbers.

    A text of more than `chunk_chars` characters is cut into chunks that overlap. These are dealt out and cut
    into pre-tokens each by itself, stitched in the text's order in a pass that holds one chunk, and the pieces
    so found are dealt out again and encoded. A shorter text is one chunk and one piece, and stays where it is.
    A single pre-token is never cut: one of millions of letters is encoded in one go, as its merges ask.

    Null and empty texts have one piece without ids. Repeated rows and null doc_ids are rows of their own. An empty
    table gives no rows. Other columns are not used.
    """
    coded = _encode_pieces(path, pattern)
    whole = _whole_texts(docs, chunk_chars).mapInArrow(coded, ENCODED)
    return whole.unionAll(_stitched(docs, path, pattern, chunk_chars, overlap).mapInArrow(coded, ENCODED))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """`encoded` with `decoded`, the bytes of its `ids` one after another. A piece may begin or end inside a character."""
    return encoded.select("row", "doc_id", "piece", "ids").mapInArrow(
        _decode_pieces(path, pattern), ENCODED + ", decoded binary"
    )


class _Document:
    """What has been seen of one row's ids and bytes."""

    def __init__(self, doc_id: int | None):
        self.doc_id, self.n_tokens = doc_id, 0
        self.ids, self.bytes = hashlib.sha256(), hashlib.sha256()

    def add(self, numbers: list[str], raw: bytes) -> None:
        if numbers:
            self.ids.update(((" " if self.n_tokens else "") + " ".join(numbers)).encode())
        self.bytes.update(raw)
        self.n_tokens += len(numbers)

    def row(self) -> tuple:
        return self.doc_id, self.n_tokens, self.ids.hexdigest(), self.bytes.hexdigest()


def _digest_pieces(path: str, pattern: str):
    schema = _schema(DIGESTED)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary(path, pattern).number
        now, document = None, None
        for batch in batches:
            done = []
            for row, doc_id, ids, raw in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "ids", "decoded"))):
                if row != now:
                    if document is not None:
                        done.append(document.row())
                    now, document = row, _Document(doc_id)
                document.add([number[i] for i in np.frombuffer(ids, "<u4").tolist()], raw)
            yield _batch(schema, done)
        if document is not None:
            yield _batch(schema, [document.row()])

    return digest


def round_trip(
    docs: DataFrame, path: str, pattern: str, chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> DataFrame:
    """Per row of `docs` the number of its ids, and digests of the ids and of the bytes they decode to.

    As `encode` and `decode` have them, in one pass over the texts that are one piece; the pieces of a longer
    text are brought together in order, and digested as they come.
    """
    steps = [f(path, pattern) for f in (_encode_pieces, _decode_pieces, _digest_pieces)]

    def all_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches

    whole = _whole_texts(docs, chunk_chars).mapInArrow(all_steps, DIGESTED)
    pieces = _stitched(docs, path, pattern, chunk_chars, overlap).mapInArrow(steps[0], ENCODED)
    placed = pieces.repartition("row").sortWithinPartitions("row", "piece")
    return whole.unionAll(decode(placed, path, pattern).mapInArrow(steps[2], DIGESTED))
