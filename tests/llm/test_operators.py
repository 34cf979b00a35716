"""Every operator against a plain version, on rows with nulls, empty and long texts, ties and copies."""

import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapwise.llm import chat, components, drawing, language, lm_score, mixing, multi_index, packing, quality, simhash, token_files, top_k

from llm_rows import odd_rows

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def rows_of(frame):
    return [tuple(row) for row in frame.collect()]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# 1

def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        weights = sum(weight[s] for s in names if s not in stopped)
        above = {s for s in names if s not in stopped and weight[s] * rest > 3 * sizes[s] * weights}
        if not above:
            return {s: 3 * sizes[s] if s in stopped else weight[s] * rest / weights for s in names}
        stopped |= above


def test_mix_comes_near_its_targets(odd):
    found = mixing.mix(odd).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(r[0]) for r in odd_rows())
    sizes = Counter()
    for _, text, _, source, _ in odd_rows():
        sizes[source] += len((text or "").encode().split())
    targets, taken = plain_targets(dict(sizes)), Counter()
    for row in found:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(targets[row.source])
        assert 0 <= row.taken <= 3 * row.size
        taken[row.source] += row.taken
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= 2 * mixing.BLOCK_WORDS, source
    assert sorted(map(str, rows_of(mixing.mix(odd)))) == sorted(map(str, found and [tuple(r) for r in found]))


def test_rows_of_one_doc_id_are_spread_over_shards(spark):
    rows = [(None if i % 3 == 1 else 5 if i % 3 else i, f"word{i} " * 20, "s") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(docs, shard_scale=20).select("doc_id", "shard", "size", "taken").collect()
    shards = Counter(r.shard for r in found)
    assert len(shards) > 20 and max(shards.values()) < 4 * len(found) / len(shards)
    for doc_id in (None, 5):
        own = Counter(r.shard for r in found if r.doc_id == doc_id)
        assert len(own) > 20 and max(own.values()) < 0.2 * sum(own.values())
    again = mixing.mix(docs.repartition(5), shard_scale=20).select("doc_id", "shard", "size", "taken").collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_quotas_are_the_highest_quotients(spark):
    rng = random.Random(3)
    rows = [(g, i, rng.choice([0, 1, 5, rng.randint(1, 10**6)]), 40 * g + 7) for g in range(6) for i in range(12)]
    frame = spark.createDataFrame(rows, "g int, i int, votes long, seats long")
    found = {(r.g, r.i): r.quota for r in mixing.apportion(frame, ["g"], "votes", "seats", ["i"]).collect()}
    for g in range(6):
        quotients = [(-votes / (2 * j + 1), i, j) for g2, i, votes, seats in rows if g2 == g and votes for j in range(40 * g + 7)]
        won = Counter(i for _, i, _ in sorted(quotients)[: 40 * g + 7])
        assert {i: found[g, i] for i in range(12)} == {i: won[i] for i in range(12)}


def test_mixed_documents_hold_the_words_taken(odd, clashing):
    want = Counter()
    for row in mixing.mix(odd).collect():
        want[row.doc_id] += row.taken
    mixed = mixing.mixed_documents(clashing)
    assert mixed.columns == clashing.columns
    have = Counter()
    for row in mixed.collect():
        have[row.doc_id] += len(row.text.encode().split())
        assert row["size"] == "x size" and (row.n_chars == len(row.text))
    assert have == +want


# 2, 3

@cache
def tokenizer(name):
    return Tokenizer.from_file(name)


def plain_ids(name, text, end):
    return tokenizer(name).encode(text or "", add_special_tokens=False).ids + [end]


def test_packing_keeps_every_piece_and_fills_bins(odd):
    found = packing.pack(odd, BYTES, 2, with_ids=True).collect()
    wanted = Counter()
    for doc_id, text, *_ in odd_rows():
        ids = plain_ids(BYTES, text, 2)
        first = len(ids) % 1024 or 1024
        bounds = [0, *range(first, len(ids) + 1, 1024)]
        wanted.update((doc_id, i, a, b - a, crc(ids[a:b])) for i, (a, b) in enumerate(zip(bounds, bounds[1:])))
    assert Counter(tuple(r)[:5] for r in found) == wanted
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in found)
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= -(-sum(r.length for r in found) // 1024) + 1


def test_best_fit_is_that_of_a_plain_search():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = rng.integers(1, 65, size=rng.integers(1, 200))
        bins, offsets = packing.best_fit_decreasing(lengths, 64)
        room = []
        for i in np.argsort(-lengths, kind="stable"):
            fits = [r for r in room if r >= lengths[i]]
            if fits:
                room[room.index(min(fits))] -= lengths[i]
            else:
                room.append(64 - lengths[i])
        assert sorted(room) == sorted(64 - np.bincount(bins, lengths).astype(int))
        assert (offsets + lengths <= 64).all()


def test_token_files_round_trip(odd, spark, tmp_path):
    files = token_files.write_token_files(odd, WORDS, 1, str(tmp_path / "ids"), frame_bytes=2048)
    found = sorted(token_files.read_token_files(files).collect(), key=lambda r: r.start)
    keys = [r.doc_id for r in found]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert Counter((r.doc_id, bytes(r.ids)) for r in found) == Counter(
        (d, np.array(plain_ids(WORDS, t, 1), "<u4").tobytes()) for d, t, *_ in odd_rows()
    )
    at = 0
    for r in found:
        assert (r.start, r.n_tokens) == (at, len(r.ids) // 4)
        at += r.n_tokens
    for file in files.collect():
        with open(file.path, "rb") as source:
            reader = token_files.FrameReader(source)
            reader.decompressed = 0
            ((_, _, ids),) = reader.documents([len(reader.keys) - 1])
            assert reader.decompressed <= -(-len(ids) // 2048) + 1
            damaged = bytearray(open(file.path, "rb").read())
        import io

        import zstandard

        plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(bytes(damaged))
        assert plain.startswith(b"") and len(plain) == reader.sizes.sum()
        damaged[6] ^= 1
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(token_files.FrameReader(io.BytesIO(bytes(damaged))).documents())


# 4

def test_scores_tell_the_target_from_the_rest(odd, nothing):
    scores = lm_score.score(odd, odd.where("lang = 'de'"), BYTES).collect()
    by = defaultdict(list)
    langs = {d: l for d, _, l, *_ in odd_rows()}
    for r in scores:
        assert r.score == pytest.approx(r.loss_target - r.loss_background)
        by[langs[r.doc_id]].append((r.n_tokens, r.score))
    assert max(s for n, s in by["de"] if n > 100) < min(s for n, s in by["en"] if n > 100)
    assert {r.score for r in lm_score.score(odd, nothing, BYTES).collect()} == {0.0}
    assert sorted(r.n_tokens for r in scores) == sorted(len(plain_ids(BYTES, t, 2)) for _, t, *_ in odd_rows())
    assert lm_score.score(nothing, odd, BYTES).count() == 0


@pytest.mark.parametrize("part_chars", [lm_score.PART_CHARS, 50])
def test_scores_are_those_of_a_plain_bigram_model(spark, part_chars):
    rng = random.Random(7)
    letters = [chr(c) for c in (*range(0x61, 0x7B), *range(0x430, 0x450), *range(0x3B1, 0x3CA), *range(0x5D0, 0x5EB), *range(0x10D0, 0x10F1))]
    kinds = ["".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(400)] + ["\u6f22", "\u5b57"]
    texts = [" ".join(rng.choices(kinds, k=rng.randint(1, 30))) for _ in range(60)]
    texts += ["\u6f22\u5b57", "\u5b57\u6f22", "", None, " \n", "a\u3000b\tc", texts[0], "same", "\u0434\u043e\u043c\u0430"]
    rows = [(i, text, int(i % 3 == 0)) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, good int").repartition(3)
    named = docs.selectExpr("*", "1 AS part", "2 AS context", "3 AS task", "4 AS ids")
    found = {r.doc_id: r for r in lm_score.score(named, docs.where("good = 1"), BYTES, part_chars).collect()}
    assert len(found) == len(rows)
    sides = {"background": [t for _, t, _ in rows], "target": [t for _, t, good in rows if good]}
    sequences = {text: ["<", *plain_ids(BYTES, text, "end")] for text in texts}
    sums = {side: sum(len(sequences[t]) - 1 for t in own) for side, own in sides.items()}
    size = Tokenizer.from_file(BYTES).get_vocab_size() + 1
    for side, own in sides.items():
        scale = min(sums.values()) / sums[side]
        ones = Counter(token for t in own for token in sequences[t][1:])
        pairs = Counter(pair for t in own for pair in zip(sequences[t], sequences[t][1:]))
        after = defaultdict(list)
        for (context, _), n in pairs.items():
            after[context].append(n)

        def chance(context, last):
            lower = (ones[last] * scale + len(ones) / size) / (sums[side] * scale + len(ones))
            followed = after[context]
            mixed = pairs[context, last] * scale + len(followed) * lower
            return mixed / (sum(followed) * scale + len(followed)) if followed else lower

        for i, text in enumerate(texts):
            s = sequences[text]
            loss = -sum(np.log(chance(a, b)) for a, b in zip(s, s[1:])) / (len(s) - 1)
            assert found[i][f"loss_{side}"] == pytest.approx(loss), (side, text)


# 5

def test_layouts_become_the_same_turns(spark):
    said = [("user", "hi <b> # \\n"), ("assistant", r"\### Assistant: </turn> ok"), ("user", ""), ("assistant", "two\nlines ")]
    records = [{"conv_id": 1, "messages": [{"role": r, "content": t} for r, t in said]}]
    records += [{"conv_id": 2, "conversations": [{"from": "human" if r == "user" else "gpt", "value": t} for r, t in said]}]
    records += [{"conv_id": 3, "turn": i, "role": r, "text": t} for i, (r, t) in enumerate(said)][::-1]
    records += [{"conv_id": 4, "prompt": said[0][1], "completion": said[1][1]}, {"conv_id": 5, "instruction": said[0][1], "output": said[1][1]}]
    lines = [json.dumps(r) for r in records] + ['{"conv_id": 9, "strange": [1]}', "no json", None, "7", '{"conv_id": 8, "messages": []}']
    turns = chat.canonical_turns(spark.createDataFrame([(x,) for x in lines], "record string"))
    unknown = turns.where("layout is null").collect()
    assert sorted(map(str, (r.conv_id for r in unknown))) == ["8", "9", "None", "None", "None"]
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns.where("layout is not null"))).collect()}
    for conv_id in (1, 2, 3, 4, 5):
        own = said if conv_id <= 3 else said[:2]
        learned = "".join(t for r, t in own if r == "assistant")
        r = found[conv_id]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_odd_turns(spark):
    rows = [(None, 0, "user", "a"), (1, None, None, None), (1, 2, "assistant", "b"), (1, 2, "assistant", "b"), (1, 2, "a: </turn>", ": ")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.canonical_turns(chat.table_records(turns)))).collect()}
    assert (found[None].n_turns, found[1].n_turns, found[1].loss_chars) == (1, 4, 2)
    assert chat.read_back(chat.format_turns(turns.where("false"))).count() == 0


BAD_RECORDS = {
    "a turn that is text": ('{"conv_id": 5, "turn": "1", "role": "user", "text": "a"}', 5),
    "a turn that is a fraction": ('{"conv_id": 5, "turn": 1.5, "role": "user", "text": "a"}', 5),
    "a turn that is true": ('{"conv_id": 5, "turn": true, "role": "user", "text": "a"}', 5),
    "a turn beyond a long": ('{"conv_id": 5, "turn": 9223372036854775808, "role": "user", "text": "a"}', 5),
    "half a surrogate pair": (r'{"conv_id": 5, "turn": 1, "role": "user", "text": "\ud800"}', 5),
    "half a pair in a role": (r'{"conv_id": 5, "turn": 1, "role": "\udfff", "text": "a"}', 5),
    "half a pair in a name": (r'{"conv_id": 5, "\ud800": 1}', None),
    "a conv_id beyond a long": ('{"conv_id": 9223372036854775808, "turn": 1, "role": "user", "text": "a"}', None),
    "a deep record": ("[" * 100_000 + "]" * 100_000, None),
    "a deep text": ('{"conv_id": 5, "x": ' + '{"a":' * 50_000 + "1" + "}" * 50_001, None),
    "a name with list marks": ('{"conv_id": 5, "messages[]": {"role": "user", "content": "a"}}', 5),
    "a name with a dot": ('{"conv_id": 5, "messages[].role": "user", "messages[].content": "a"}', 5),
    "a list of texts": ('{"conv_id": 5, "messages": ["role", "content"]}', 5),
    "a number": ("7", None),
    "a long number": ('{"conv_id": 5, "turn": ' + "9" * 5_000 + ', "role": "user", "text": "a"}', None),
    "nothing": (None, None),
}


@pytest.mark.parametrize("kind", BAD_RECORDS)
def test_bad_records_give_a_row_without_a_layout(spark, kind):
    record, conv_id = BAD_RECORDS[kind]
    good = r'{"conv_id": 5, "turn": 2, "role": "user", "text": "\ud83d\ude42 \u00e9"}'
    records = spark.createDataFrame([(record,), (good,)], "record string")
    rows = sorted(chat.canonical_turns(records).collect(), key=lambda r: r.layout is not None)
    assert (rows[0].conv_id, *rows[0][1:5]) == (conv_id, None, None, None, None)
    assert tuple(rows[1])[:5] == (5, 2, "user", "\U0001f642 é", "turn")
    assert sum(r.n_turns for r in chat.read_back(chat.format_turns(chat.canonical_turns(records))).collect()) == 2


# 6

def plain_fingerprint(text, n=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            least = min(root[a], root[b])
            changed |= root[a] != least or root[b] != least
            root[a] = root[b] = least
    return root


@pytest.mark.parametrize("text", ["", None, "A b", "One two THREE four five", "É à x y z É", "a " * 50, "w1 w2 w3 w4 " * 9])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("lot", [3, 2048])
def test_links_lose_no_close_pair(spark, lot):
    rng = random.Random(lot)
    bits = {0, 2**64 - 1}
    for _ in range(25):
        one = rng.getrandbits(64)
        for _ in range(12):
            bits.add(one)
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                one ^= 1 << bit
    signed = [b - (1 << 64) if b >> 63 else b for b in bits]
    found = simhash.links(spark.createDataFrame([(b,) for b in signed], "bits long"), lot=lot)
    pairs = rows_of(found)
    close = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 * len(bits) for a, b in pairs)
    wanted = plain_components(signed, close)
    assert plain_components(signed, pairs) == wanted
    roots = dict(rows_of(components.components(found)))
    assert {s: roots.get(s, s) for s in signed} == wanted


def test_near_duplicates_and_what_stays(odd, clashing, nothing):
    found = simhash.near_duplicates(odd).collect()
    prints = {(d, plain_fingerprint(t)) for d, t, *_ in odd_rows()}
    assert {(r.doc_id, int(r.fingerprint, 16)) for r in found} == prints and len(found) == len(odd_rows())
    values = [p for _, p in prints]
    root = plain_components(values, [(a, b) for a in values for b in values if (a ^ b).bit_count() <= 4])
    least = {}
    for d, p in prints:
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    assert all(r.component_id == least.get(root[int(r.fingerprint, 16)]) for r in found)
    stay = simhash.keep_one(clashing)
    assert stay.columns == clashing.columns
    left = stay.collect()
    assert len(left) == len(set(root.values()))
    assert Counter(str(r.doc_id) for r in left) == Counter(str(least.get(v)) for v in set(root.values()))
    assert simhash.near_duplicates(nothing).count() == simhash.keep_one(nothing).count() == 0


# 7, 10

def odd_vectors(seed=0, n=300, d=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d))
    near = np.repeat(base[:20], 4, axis=0) + 0.03 * rng.normal(size=(80, d))
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, near, near[:3]]))]
    rows += [(1000, None), (1001, [0.0] * d), (1002, [float("nan")] + [1.0] * (d - 1)), (1003, [float("inf")] * d),
             (1004, [None] * d), (1005, []), (1006, base[0][:3].tolist()), (None, base[0].tolist()), (1020, base[0].tolist())]
    return rows


@pytest.mark.parametrize("lot", [7, 1024])
def test_vector_links(spark, lot):
    rows = odd_vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = multi_index.near_duplicates(frame, cell_rows=16, lot=lot).collect()
    assert len(found) == len(rows)
    sound = {i: np.array(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    unit = {i: v / np.linalg.norm(v) for i, v in sound.items()}
    pairs = [(a, b) for a in unit for b in unit if a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.95]
    degree, root = Counter(a for a, _ in pairs), plain_components(unit, pairs)
    kept = sum(r.n_links for r in found)
    assert 0.9 * len(pairs) <= kept <= len(pairs)
    assert all(r.n_links <= degree[r.vec_id] for r in found)
    same = sum(r.component_id == root.get(r.vec_id, r.vec_id) for r in found)
    assert same >= 0.95 * len(found)
    assert all(r.kept == (r.component_id == r.vec_id) if r.vec_id is not None else r.kept is None for r in found)
    assert multi_index.near_duplicates(frame.where("false")).count() == 0
    assert multi_index.near_duplicates(frame.where("vec_id = 1000")).collect()[0].n_links == 0


def test_nearest_cells_are_those_of_a_full_sort():
    rng = np.random.default_rng(4)
    points, books = rng.normal(size=(40, 6)), (rng.normal(size=(7, 3)), rng.normal(size=(5, 3)))
    for visits in (1, 2, 9, 35):
        found = multi_index.nearest_cells(points, books, visits)
        for p, own in zip(points, found):
            full = ((p[:3] - books[0]) ** 2).sum(1)[:, None] + ((p[3:] - books[1]) ** 2).sum(1)
            assert np.allclose(full.ravel()[own], np.sort(full.ravel())[:visits])


@pytest.mark.parametrize("scale", [1, 10**4, 10**9, 2**59])
def test_top_k(spark, scale):
    rng = random.Random(5)
    rows = [(i, [rng.randint(-9, 9) * scale for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(20)] + [(300, None), (None, [1] * 6), (301, [1, 2])]
    frame = spark.createDataFrame(rows, "vec_id long, v array<long>")
    found = top_k.top_k(frame.where("vec_id % 20 = 0"), frame, k=5, list_rows=40, query_rows=3).collect()
    have = defaultdict(list)
    for r in sorted(found):
        have[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(have[r.query_id])
    clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    for q, v in rows:
        if q is not None and v is not None and q % 20 == 0:
            scores = [(-clip(sum(a * b for a, b in zip(v, w))), i) for i, w in rows if i not in (None, q) and w and len(w) == len(v)]
            assert have[q] == [(i, -s) for s, i in sorted(scores)[:5]], q
    assert top_k.top_k(frame.where("false"), frame).count() == top_k.top_k(frame, frame.where("false")).count() == 0
    # Rows that share a vec_id are candidates each, but not of their own query; further columns don't matter.
    shared = frame.unionAll(frame.where("vec_id = 20")).selectExpr("*", "1 AS d", "2 AS lists", "3 AS kind", "4 AS score")
    again = top_k.top_k(shared.where("vec_id % 20 = 0"), shared, k=5, list_rows=40, query_rows=3).collect()
    assert [tuple(r) for r in sorted(again) if r.query_id == 20] == [tuple(r) for r in sorted(found) if r.query_id == 20]


def test_unsound_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, []), (3, [nan, 1.0]), (4, [1.0, -inf]), (5, [None, 1.0]), (6, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [r.vec_id for r in frame.where(top_k.sound("embedding")).collect()] == [0, 6]


@pytest.mark.parametrize("kind", ["skewed", "flat", "ties"])
def test_reading_stops_when_no_outsider_qualifies(kind):
    rng = np.random.default_rng(11)
    n, d, k = 3000, 12, 20
    if kind == "skewed":
        values = np.floor(rng.pareto(0.7, (n, d)) * 4).clip(0, 100_000)
    else:
        values = rng.integers(-60, 60, (n, d)) if kind == "flat" else rng.integers(0, 2, (n, d))
    values = values.astype(np.float64)
    queries = values[:40].copy()
    lists = top_k.SortedLists(np.arange(n), values)
    alive, entries = top_k.qualified(np.arange(40), queries, lists, k)
    scores = queries @ values.T
    scores[np.arange(40), np.arange(40)] = -np.inf
    bar = np.sort(scores, axis=1)[:, -k]
    assert (alive | (scores < bar[:, None])).all()
    every = n * np.count_nonzero(queries)
    if kind == "skewed":
        assert entries < 0.35 * every
    else:
        assert 0.5 * every < entries <= every
    query, found, got = top_k.search(np.arange(40), queries, lists, k)
    for i in range(40):
        want = sorted((-s, j) for j, s in enumerate(scores[i]))[:k]
        assert list(zip(-got[query == i], found[query == i])) == want


# 8

def test_votes_are_those_of_a_plain_search(odd, clashing, nothing, spark, labels_dir):
    labels = spark.read.parquet(f"{labels_dir}/labels.parquet")
    space = quality.learn(odd, labels)
    assert set(space.labels) == {0, 1}
    found = quality.score(odd.select("doc_id", "text"), space).collect()
    for r in found:
        own = space.place(quality.term_counts(r.text)[None])[0]
        cosines = sorted(zip((space.vectors @ own).tolist(), space.labels.tolist()), reverse=True)
        last = cosines[min(quality.NEIGHBOURS, len(cosines)) - 1][0]
        votes = [(max(c, 0) ** quality.SHARPNESS, label) for c, label in cosines if c >= last - 1e-6]
        total = sum(v for v, _ in votes)
        wanted = sum(v * label for v, label in votes) / total if total else space.prior
        assert r.score == pytest.approx(wanted, abs=1e-3)
        assert r.predicted == int(r.score >= 0.3)
    named = quality.score(clashing, space, names=("_score", "_predicted"))
    assert named.columns == [*clashing.columns, "_score", "_predicted"] and named.count() == len(odd_rows())
    none = quality.learn(nothing, labels.where("false"))
    assert {r.score for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.score(nothing, space).count() == 0


def test_recurrences_are_counted_by_distance():
    words = "a a b a c c c b x y z a".split()
    back = quality.term_counts(" ".join(words))[quality.TERMS :].tolist()
    want = Counter()
    for i, word in enumerate(words):
        ago = next((i - j for j in range(i - 1, -1, -1) if words[j] == word), 0)
        want[ago.bit_length()] += 1
    assert back == [want[i] for i in range(quality.RECURRENCES)] and sum(back) == len(words)
    assert not quality.term_counts("ab").any() and not quality.term_counts(None).any()


def test_nothing_is_learned_from_held_out_rows(spark):
    ids = [i for i in range(400)]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    kept = {r[0] for r in frame.where(~quality.held_out()).collect()}
    assert kept == {i for i in ids if zlib.crc32(str(i).encode()) % 5 != 0}
    kept = {r[0] for r in frame.where(~language.held_out()).collect()}
    assert kept == {i for i in ids if zlib.crc32(str(i).encode()) % 4 != 2}


def test_terms_are_weighted_by_all_documents(odd, spark, labels_dir):
    space = quality.learn(odd, spark.read.parquet(f"{labels_dir}/labels.parquet"), sample_per_class=3)
    counts = np.stack([quality.term_counts(text) for _, text, *_ in odd_rows()])[:, : quality.TERMS]
    assert np.allclose(space.idf, np.log((len(counts) + 1) / ((counts > 0).sum(axis=0) + 1)) + 0.1)


# 9

def test_posteriors_are_those_of_all_labelings():
    from itertools import product

    rng = np.random.default_rng(6)
    k, sizes = 3, [1, 4, 5, 2]
    n = sum(sizes)
    e, moves, start = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    begins = np.zeros(n, bool)
    begins[np.cumsum(sizes) - sizes] = True
    found, expected = language.posteriors(e, begins, moves, start)
    wanted, moved = np.zeros((n, k)), np.zeros((k, k))
    for at, size in zip(np.cumsum(sizes) - sizes, sizes):
        weights = {}
        for labels in product(range(k), repeat=size):
            score = start[labels[0]] + sum(e[at + i, l] for i, l in enumerate(labels)) + sum(moves[a, b] for a, b in zip(labels, labels[1:]))
            weights[labels] = np.exp(score)
        total = sum(weights.values())
        for labels, w in weights.items():
            for i, l in enumerate(labels):
                wanted[at + i, l] += w / total
            for a, b in zip(labels, labels[1:]):
                moved[a, b] += w / total
    assert np.allclose(found, wanted) and np.allclose(expected, moved)


def test_languages(odd, clashing, nothing):
    field = language.learn(odd)
    assert field.languages == ["de", "en"]
    found = language.identify(odd, field).collect()
    for r in found:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.lang and len(r.text) > 60:
            assert r.lang_pred == r.lang
        assert 0 <= r.score <= 1
    named = language.identify(clashing, field, ("_p", "_s"))
    assert named.columns == [*clashing.columns, "_p", "_s"] and named.count() == len(odd_rows())
    switched = " ".join(odd_rows()[0][1].split()[:40] + odd_rows()[9][1].split()[:40])
    labels = [own for _, own, _ in language.label_words(switched, field)]
    assert labels[:36].count("en") >= 34 and labels[44:].count("de") >= 34
    assert language.learn(nothing) is None
    assert {r.lang_pred for r in language.identify(odd, None).collect()} == {"und"}
    assert language.identify(nothing, field).count() == 0


def test_every_language_is_learned(spark):
    rng = random.Random(9)
    texts = {i: [" ".join(chr(0x4E00 + 3 * i + rng.randrange(3)) * rng.randint(1, 4) for _ in range(30)) for _ in range(6)] for i in range(70)}
    rows = [(10 * i + j, text, f"l{i:02}") for i, own in texts.items() for j, text in enumerate(own)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    field = language.learn(docs)
    assert field.languages == [f"l{i:02}" for i in range(70)]
    assert all(r.lang_pred == r.lang for r in language.identify(docs, field).collect())


def test_samples_hold_at_any_size(spark):
    # As 300 of 314,572,801: with 2**20 steps one language this frequent had no share.
    n = 3_200_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("one two").alias("text"), F.lit("en").alias("lang"))
    assert language.learn(docs, docs_per_language=2).languages == ["en"]
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert len(quality.learn(docs, labels, sample_per_class=2).vectors) > 0
    assert drawing.share(10**12, 300) * 10**12 // drawing.DRAW in (299, 300)
    assert drawing.share(10**30, 1) == 1 and drawing.share(5, 5) == drawing.DRAW


def test_long_words_are_learned_whole(spark):
    rng = random.Random(4)
    rows = [(i, "z" * 64 + "".join(rng.choices("abc" if i % 2 else "def", k=200)), "x" if i % 2 else "y") for i in range(40)]
    assert [len(w) for w in language.words_of(rows[0][1])] == [64, 64, 64, 64, 8]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(r.lang_pred == r.lang for r in language.identify(docs, language.learn(docs)).collect())


def test_repeated_rows_do_not_fill_the_sample(spark, monkeypatch):
    rows = [(7, "one two three", "en")] * 500 + [(100 + i, f"other words {i}", "en") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert len(quality.learn(docs, labels).vectors) <= 41
    seen = []
    monkeypatch.setattr(language, "fit", lambda sample: seen.extend(sample))
    language.learn(docs, docs_per_language=1000)
    assert 0 < len(seen) <= 41


# Empty tables

def test_empty_tables(nothing, spark):
    assert mixing.mix(nothing).count() == mixing.mixed_documents(nothing).count() == 0
    assert packing.pack(nothing, BYTES, 2).count() == 0
    assert token_files.read_token_files(token_files.write_token_files(nothing, WORDS, 1)).count() == 0
    assert lm_score.score(nothing, nothing, BYTES).count() == 0
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
