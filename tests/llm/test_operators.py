"""Operators against brute force, and on awkward rows."""

import hashlib
import itertools
import math
import random
import struct
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from murmura.llm import (
    bpe,
    components,
    learning,
    lines,
    mixing,
    outliers,
    quality,
    records,
    secrets,
    simhash,
    spots,
    toxicity,
)
from murmura.storage import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, key int, target string, place int"
SF = "/root/testdata/sf0.001"


def rows_of(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return [
        (i, t, "en" if k % 3 else None, f"s{k % 2}" if k % 5 else None, len(t or ""), "x", 1, "y", 2)
        for k, (i, t) in enumerate(zip(ids, texts))
    ]


AWKWARD = [
    None,
    "",
    "   \n\t ",
    "one",
    "The quick brown fox of the house jumps over a lazy dog in the garden.\nA second line of words here.",
    "The quick brown fox of the house jumps over a lazy dog in the garden.\nA second line of words here.",
    "the QUICK brown fox of the house jumps over a lazy dog in the garden",
    "é ß 日本語 😀 <|endoftext|> x" + "=" * 3000,
    " ".join(f"word{i % 977}" for i in range(30_000)),
    "x\n\n\nx\nx",
    "password=abc1234567890abcdef0 mail a.long.name99@example.com",
]


@pytest.fixture(scope="module")
def awkward(spark):
    ids = [None, 1, 2, 3, 4, 5, 5, 7, 8, 9, 9]
    data = rows_of(AWKWARD, ids)
    return spark.createDataFrame([*data, data[4]], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(40)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# -- byte-pair encoding ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def model():
    with open(VOCABULARY, encoding="utf-8") as file:
        return bpe.Model(file.read())


def streamed(model, text, step):
    encoder = bpe.Encoder(model)
    out = b"".join(encoder.feed(text[at : at + step]) for at in range(0, len(text), step)) + encoder.finish()
    return list(struct.unpack(f"<{len(out) // 4}I", out))


def awkward_texts(n, seed=3):
    rnd = random.Random(seed)
    parts = ["a", "e", " ", "  ", "\n", "\t", "'s", "'r", "ll", "23", "é", "日本", "😀", "<|endoftext|>", "<|endo", "|>", "!", "--",
             "aaaaaaaaaaaaaaaa", " ", "　", "\x1c", "\x85", "the", "ing", " of", "Ᲊ", "՘", "\0"]
    for _ in range(n):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 50)))
        if rnd.random() < 0.2:
            text += rnd.choice(parts) * rnd.randint(50, 900) + rnd.choice(parts)
        yield rnd, text


def test_encoder_equals_the_library_for_any_chunks(model, library):
    for rnd, text in awkward_texts(1200):
        assert streamed(model, text, rnd.choice([1, 2, 5, 19, 1000])) == library.encode(text, add_special_tokens=False).ids


def test_encoder_memory_is_bounded(model):
    for unit in ("a", "ab", " ", "-", "é"):
        encoder = bpe.Encoder(model)
        for _ in range(60):
            encoder.feed(unit * 500)
            assert len(encoder.text) + len(encoder.piece or b"") < 4000


def test_decoder_holds_back_unfinished_characters(model):
    decoder = bpe.Decoder(model)
    ids = np.array([model.byte_ids[b] for b in "é😀".encode()], "<u4")
    assert [decoder.feed(ids[i : i + 1].tobytes()) for i in range(len(ids))] == ["", "é", "", "", "", "😀"]
    assert decoder.feed(np.array([model.byte_ids[0xF0]], "<u4").tobytes()) + decoder.finish() == "�"


def test_encode_decode_rows(spark, awkward, library):
    got = Counter(tuple(r) for r in bpe.encode_decode(awkward, VOCABULARY).collect())
    want = Counter()
    for r in awkward.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[(r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert got == want


# -- records --------------------------------------------------------------------------------------


def test_library_encoder_by_units(library):
    with open(VOCABULARY, encoding="utf-8") as file:
        encoder = records.LibraryEncoder(file.read())
    texts = [t for _, t in awkward_texts(600, seed=5)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_records_round_trip(spark, awkward, library):
    got = [tuple(r)[:4] for r in records.written_and_read(awkward, VOCABULARY).collect()]
    got.sort(key=lambda r: r[1])
    data = sorted(awkward.collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id)
    by_id, start = {}, 0
    for r in data:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        by_id.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    for doc_id, begin, n, crc in got:
        assert begin == start
        by_id[doc_id].remove((n, crc))
        start += n
    assert not any(by_id.values()) and [r[0] for r in got] == [r.doc_id for r in data]


def test_pieces_are_the_librarys(library):
    """Texts of awkward blanks and signs, cut into pieces, against whole calls of the library."""
    with open(VOCABULARY) as file:
        encoder = records.LibraryEncoder(file.read())
    draw = random.Random(5)
    parts = [" ", " ", "  ", "\n", "\r\n", "\t", "\u00a0", "\u3000", "\x1c", "a", "B", "zé", "ß", "1", "'s", "'", ".", "###", "日本", "\0", "<|endoftext|>", "a\u0301"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 16))) for _ in range(1500)]
    encoded = encoder.encode(pa.array(texts))
    assert [x.tolist() for x in encoded] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.encode(pa.array(texts).slice(700, 50))] == [x.tolist() for x in encoded[700:750]]
    assert encoder.encode(pa.array([], pa.string())) == []


def test_a_full_memo_is_emptied(library, monkeypatch):
    monkeypatch.setattr(records, "MEMO", 10)
    with open(VOCABULARY) as file:
        encoder = records.LibraryEncoder(file.read())
    for text in AWKWARD[3:] * 2:
        assert encoder.encode(pa.array([text]))[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_slices_cover_all_rows(monkeypatch):
    monkeypatch.setattr(records, "TOGETHER", 10)
    texts = pa.array(["x" * n for n in (0, 3, 7, 1, 40, 0, 9, 2)])
    assert list(records.slices(texts)) == [(0, 3), (3, 1), (4, 1), (5, 2), (7, 1)]
    assert list(records.slices(pa.array([], pa.string()))) == []


def test_files_follow_each_other_by_number(spark):
    """From the hundred thousandth file on names don't sort as their numbers do."""
    numbers = [99_998, 99_999, 100_000, 100_001, 1_000_000]
    rows = [(f"part-{n:05d}-1f.c000.txt", k, 0, 1, 10 + k, 0, 0) for k, n in enumerate(numbers)]
    got = records.with_starts(spark.createDataFrame(rows, records.INDEX)).orderBy("doc_id").select("start").collect()
    assert [r["start"] for r in got] == [0, 10, 21, 33, 46]


def test_more_text_makes_more_files(spark, monkeypatch):
    monkeypatch.setattr(records, "FILE_BYTES", 1000)
    docs = spark.createDataFrame([(i, f"text {i} " * 20) for i in range(400)], "doc_id long, text string")
    size = docs.selectExpr("sum(octet_length(text))").first()[0]
    assert records.n_files(docs) == size // 1000 + 1
    folder = scratch_path(spark, "test-many-files")
    records.write_records(docs, VOCABULARY, folder)
    index = records.read_index(spark, folder)
    assert index.select("file").distinct().count() > 20 and index.count() == 400
    assert sorted(records.scan(spark, folder).collect()) == sorted(index.collect())


def test_damaged_records_are_refused_and_any_order_can_be_read(spark):
    whole = records.record(7, np.array([1, 2, 3], "<u4"), 2) + b"\n" + records.record(None, np.array([70_000], "<u4"), 4) + b"\n"
    assert [(d, ids.tolist()) for d, _, _, ids in records.parse(whole)] == [(7, [1, 2, 3]), (None, [70_000])]
    for at in (0, 9, 20, len(whole) - 3):
        with pytest.raises(ValueError):
            list(records.parse(whole[:at] + bytes([whole[at] ^ 1]) + whole[at + 1 :]))
    folder = scratch_path(spark, "test-records")
    records.write_records(documents(spark).limit(50), VOCABULARY, folder)
    index = records.read_index(spark, folder)
    rows = records.shuffled(spark, folder, index, 1).collect()
    assert len(rows) == 50 and [r.doc_id for r in rows] != sorted(r.doc_id for r in rows)
    counts = {r.doc_id: r.n_tokens for r in index.collect()}
    assert all(len(r.ids) == counts[r.doc_id] for r in rows)


# -- simhash --------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, awkward):
    for r in simhash.near_duplicates(awkward).collect():
        texts = [x.text or "" for x in awkward.collect() if x.doc_id == r.doc_id]
        assert r.fingerprint in {f"{plain_fingerprint(t):016x}" for t in texts}


@pytest.mark.parametrize("cell", [2_000, 3])
def test_links_are_all_found(spark, cell):
    rnd = random.Random(1)
    points = set()
    for _ in range(40):
        base = rnd.getrandbits(64)
        for _ in range(12):
            points.add(base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))))
    points = [p - (1 << 64) if p >> 63 else p for p in points]
    frame = spark.createDataFrame([(p,) for p in points], "fp long")
    got = {(r.a, r.b) for r in simhash.links(frame, cell=cell).collect()}
    assert got == {(a, b) for a in points for b in points if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}


def test_lower_bound(spark):
    rnd = random.Random(2)
    pairs = [(rnd.getrandbits(63), rnd.getrandbits(63)) for _ in range(200)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    spot = frame.select("a", "b", simhash.embedded(frame.a).alias("x"), simhash.embedded(frame.b).alias("y"))
    for a, b, x, y in spot.collect():
        count = lambda v: [(v >> 2 * i & 3).bit_count() for i in range(32)]
        manhattan = sum(abs(i - j) for i, j in zip(count(a), count(b)))
        assert ((x ^ y) & (1 << 64) - 1).bit_count() == manhattan <= (a ^ b).bit_count()


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(edges + [(None, 1)], "a long, b long"), "test").collect()
    assert {(r.node, r.root) for r in got} == {(x, root(x)) for x in linked} and len(got) == len(linked)


def test_simhash_keeps_one_document_of_each_group(spark, awkward):
    kept = simhash.deduplicated(awkward)
    assert kept.columns == awkward.columns
    groups = {r.component_id for r in simhash.near_duplicates(awkward).collect()}
    assert Counter(r.doc_id for r in kept.collect()).keys() == groups


# -- mixing ---------------------------------------------------------------------------------------


def test_mix(spark, awkward):
    report = mixing.mix_report(documents(spark)).collect()
    sizes, targets, taken = Counter(), {}, Counter()
    source = {r.doc_id: r.source for r in documents(spark).collect()}
    for r in report:
        sizes[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        targets[source[r.doc_id]] = r.target
        assert r.taken <= 2 * r["size"]
    total = sum(sizes.values())
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    assert all(targets[s] <= 2 * sizes[s] for s in sizes)
    open_sources = [s for s in sizes if targets[s] < 2 * sizes[s] - 1e-6]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    assert len({round(targets[s] / weight[s], 3) for s in open_sources}) <= 1
    assert sum(taken.values()) == pytest.approx(1.5 * total, rel=0.1)
    mixed = mixing.mix(documents(spark))
    assert mixed.columns == documents(spark).columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert all(copies[r.doc_id] * r["size"] == r.taken for r in report)
    assert mixing.mix(awkward).columns == awkward.columns and mixing.mix(awkward).count() > 0


# -- lines ----------------------------------------------------------------------------------------


def test_lines(spark):
    base = " ".join(f"thing{i} and" for i in range(40))
    near = base.replace("thing7 ", "other7 ")
    far = " ".join(f"stuff{i} or" for i in range(40))
    docs = spark.createDataFrame(rows_of([f"{base}\n{far}\n\nshort line", f"Intro here now\n{near}", f"{base.upper()}\n\n{far}  tail", None, "", base]), SCHEMA)
    got = {r.doc_id: r for r in lines.deduplicated(docs).collect()}
    assert got[0].text == f"{base}\n{far}\n\nshort line" and got[1].text == "Intro here now"
    assert got[2].text == "" and got[3].text is None and got[4].text == "" and got[5].text == ""
    assert (got[2].llm_lines, got[2].llm_removed, got[1].n_chars) == (2, 2, 14)
    assert lines.clean(docs).columns == docs.columns


def test_lines_against_all_pairs(spark):
    """Every kept line differs from every other, but for the few similar pairs that no band brings together."""
    rnd = random.Random(6)
    vocabulary = [f"w{i}{'abc'[i % 3] * (i % 5)}" for i in range(400)]
    texts = []
    for _ in range(30):
        line = [rnd.choice(vocabulary) for _ in range(40)]
        for _ in range(6):
            varied = list(line)
            for at in rnd.sample(range(40), rnd.randint(0, 3)):
                varied[at] = rnd.choice(vocabulary)
            texts.append(" ".join(varied))
    got = lines.report(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    removed = {r.doc_id for r in got if r.n_removed}
    want = linked_lines(texts)
    assert removed <= want and len(removed) >= 0.98 * len(want)


def character_shingles(line):
    line = " ".join(line.lower().split())
    return {line[i : i + 5] for i in range(max(1, len(line) - 4))}


def linked_lines(texts):
    """The numbers of the lines that go, by all pairs of plain character shingles."""
    parent = list(range(len(texts)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    sets = [character_shingles(t) for t in texts]
    for a in range(len(texts)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i for i in range(len(texts)) if root(i) != i}


def test_columns_named_like_the_operators_own_pass_through(spark):
    texts = ["a first line of words here\na second line of words", "a first line of words here", None]
    schema = SCHEMA.replace("fp string, key int, target string, place int", "llm_lines string, mix_copies int, LLM_places string, mix_size int")
    docs = spark.createDataFrame(rows_of(texts), schema)
    cleaned = lines.clean(docs)
    assert cleaned.columns == docs.columns
    assert [(r.doc_id, r.llm_lines, r["LLM_places"]) for r in cleaned.orderBy("doc_id").collect()] == [(i, "x", "y") for i in range(3)]
    assert sorted(r.text or "" for r in cleaned.collect()) == ["", "", texts[0]]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {(r.mix_copies, r.mix_size) for r in mixed.collect()} == {(1, 2)}


def test_verified_pairs_are_not_lost_to_sketches(spark):
    """Bitmaps and sizes only rule out pairs below the similarity, also of very long lines."""
    rnd, texts = random.Random(4), []
    for n in (1, 3, 12, 60, 700):
        line = "".join(rnd.choice("abcdefgh ") for _ in range(n * 6))
        for share in (0.0, 0.01, 0.02, 0.04, 0.1):
            texts.append("".join(rnd.choice("xyz") if rnd.random() < share else c for c in line))
    sets = lines.shingle_sets(spark.createDataFrame(list(enumerate(texts)), "key long, line string"))
    a, b = sets.alias("a"), sets.alias("b")
    shared = F.size(F.array_intersect("a.hashes", "b.hashes"))
    total = F.size("a.hashes") + F.size("b.hashes") - shared
    rows = a.join(b, F.col("a.key") < F.col("b.key")).select(
        F.col("a.key").alias("i"), F.col("b.key").alias("j"), (shared >= 0.8 * total).alias("similar"),
        lines._may_be_similar("a.sketch", "b.sketch").alias("possible"),
    ).collect()
    plain = [character_shingles(t) for t in texts]
    for r in rows:
        x, y = plain[r.i], plain[r.j]
        assert r.similar == (len(x & y) >= 0.8 * len(x | y)) and (r.possible or not r.similar)
    assert sum(r.similar for r in rows) > 5 and sum(not r.possible for r in rows) > 100


def test_bitmaps_tell_long_lines_apart(spark):
    """Lines of 440 characters with half of their shingles in common: their bitmaps aren't full."""
    rnd, rows = random.Random(6), []
    for k in range(20):
        words = ["".join(rnd.choices("abcdefghijklmnop", k=10)) for _ in range(40)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:27], *["".join(rnd.choices("abcdefghijklmnop", k=10)) for _ in range(13)]]))]
    sets = lines.shingle_sets(spark.createDataFrame(rows, "key long, line string"), with_hashes=False)
    a, b = sets.alias("a"), sets.alias("b")
    pairs = a.join(b, (F.col("a.key") + 1 == F.col("b.key")) & (F.col("a.key") % 2 == 0))
    possible = pairs.select(lines._may_be_similar("a.sketch", "b.sketch").alias("p")).collect()
    assert len(possible) == 20 and not any(r.p for r in possible)


def test_buckets_of_some_hundred_lines_are_not_cut_into_shingles(spark, monkeypatch):
    rnd = random.Random(7)
    texts = [" ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(12)) for _ in range(150)]
    texts.append(texts[0][:-1] + "x")
    frame = spark.createDataFrame([(b"%06d" % i, t) for i, t in enumerate(texts)], "key binary, line string")
    open_ = lines.shingle_sets(frame, with_hashes=False).selectExpr("1L as band", "key", "sketch", "key as root")
    many, between = [], lines._between_many
    monkeypatch.setattr(lines, "_between_many", lambda rows, *more: many.append(rows.count()) or between(rows, *more))
    got = lines._between(open_, frame, lines.Scratch(spark, "test-lines")).collect()
    assert many == [0] and [(int(r.a), int(r.b)) for r in got] == [(0, 150)]


def test_shingles_are_windows_at_every_place(spark):
    texts = ["a", "four", "fives", "x" * 64 + "yz", "ab😀日本語 d", "".join(chr(0x4E00 + i % 211) for i in range(300)), "w " * 100 + "end"]
    frame = spark.createDataFrame([(t, t) for t in texts], "key string, line string")
    wanted = {(t, s) for t in texts for s in character_shingles(t)}
    plain = spark.createDataFrame(sorted(wanted), "key string, s string").selectExpr("key", f"xxhash64(s) & {lines.LOW} as hash")
    assert {tuple(r) for r in lines.shingle_hashes(frame).collect()} == {tuple(r) for r in plain.collect()}


def test_batches_of_lines_have_the_windows_of_each_line(monkeypatch):
    texts = ["a", "abc", "abc\0\0", "fives", "\u65e5\u672c\u8a9e\U0001f600 \U0001f600 x", "x" * 40, "abcdefgh" * 30, "", "fives"]
    number = {}
    for piece in (lines.windows.PIECE, 1, 20):
        monkeypatch.setattr(lines.windows, "PIECE", piece)
        batch = pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "line": texts})
        made = [r for b in lines.windows.sketching(True)(iter([batch])) for r in b.to_pylist()]
        assert [r["key"] for r in made] == list(range(len(texts)))
        for r, text in zip(made, texts):
            shingles = character_shingles(text) if text else {""}
            assert len(r["hashes"]) == r["sketch"]["n"] == len(set(r["hashes"])) == len(shingles)
            assert number.setdefault(text, r["hashes"]) == r["hashes"]
        signed = [r for b in lines.windows.signing(lines.FACTORS, lines.ROWS)(iter([batch])) for r in b.to_pylist()]
        for r in signed:
            hashes = number[texts[r["key"]]]
            least = [min(h * f & lines.LOW for h in hashes) for f in lines.FACTORS]
            assert number.setdefault(tuple(least), [r[f"b{i}"] for i in range(lines.BANDS)]) == [r[f"b{i}"] for i in range(lines.BANDS)]
    assert len({tuple(v) for k, v in number.items() if isinstance(k, str)}) == len(set(texts))


def test_sets_of_shingles_are_not_stored(spark, monkeypatch):
    """They take several times the room of the lines, so lines are stored and travel in their place."""
    kept, keep = [], lines.Scratch.keep
    monkeypatch.setattr(lines.Scratch, "keep", lambda self, df, name: kept.append(df.schema.simpleString()) or keep(self, df, name))
    texts = ["one line that is here and there again", "one line that is here and there again!", "another line of words"]
    got = lines.report(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()
    assert sum(r.n_removed for r in got) == 1 and kept and not any("hashes" in schema for schema in kept)


def test_rare_shingles_are_found_in_the_batch(spark, monkeypatch):
    """Of large buckets only the first shingles become rows, and in slices; lines share one as similar lines must."""
    rnd = random.Random(12)
    words = ["".join(rnd.choices("abcdefg", k=rnd.randint(1, 7))) for _ in range(300)]
    texts = []
    for _ in range(50):
        line = [rnd.choice(words) for _ in range(rnd.randint(8, 40))]
        for _ in range(4):
            varied = list(line)
            varied[rnd.randrange(len(line))] = rnd.choice(words)
            texts.append(" ".join(varied))
    texts = sorted(set(texts))
    sets = [character_shingles(t) for t in texts]
    batch = pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "line": texts})
    often = next(lines.windows.tallying()(iter([batch])))
    run = lines.windows.leading(often["slot"].to_numpy(), often["often"].to_numpy(), 0.8)
    firsts = [r for b in run(iter([batch])) for r in b.to_pylist()]
    for r, s in zip(firsts, sets):
        assert r["skipped"] + len(r["firsts"]) == len(s) - math.ceil(0.8 * len(s)) + 1
    similar = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(similar) > 20 and all(set(firsts[i]["firsts"]) & set(firsts[j]["firsts"]) for i, j in similar)

    kept, keep = {}, lines.Scratch.keep
    monkeypatch.setattr(lines.Scratch, "keep", lambda self, df, name: kept.setdefault(name, []).append(df.columns) or keep(self, df, name))
    monkeypatch.setattr(lines, "PAIRED", 1)
    monkeypatch.setattr(lines, "SLICE_ROWS", 1)
    frame = spark.createDataFrame([(b"%06d" % i, t) for i, t in enumerate(texts)], "key binary, line string")
    sketches = lines.shingle_sets(frame, with_hashes=False)
    # One bucket a slice, with every line in it; each line is a component of its own.
    open_ = sketches.select(F.explode(F.sequence(F.lit(0), F.lit(5)).cast("array<bigint>")).alias("band"), "key", "sketch", F.col("key").alias("root"))
    scratch = lines.Scratch(spark, "test-lines")
    got = {(int(r.b), int(r.a)) for r in lines._between(open_, frame, scratch).collect()}
    assert got >= set(similar) and len(got) < len(texts) * (len(texts) - 1) / 8
    assert sorted(k for k in kept if k.startswith("found")) == [f"found-{i}" for i in range(lines.SLICES)]


def test_short_lines_and_lines_without_blanks(spark):
    """One letter changed in a line of 60 to 110 characters: words, addresses, signs without blanks."""
    rnd = random.Random(8)
    letters, texts = "abcdefghijklmnoprstuvw", []
    for k in range(120):
        n = rnd.randint(60, 110)
        if k % 3 == 0:
            line = list(" ".join("".join(rnd.choices(letters, k=rnd.randint(3, 9))) for _ in range(n // 7)))
        elif k % 3 == 1:
            line = list("https://" + "".join(rnd.choices(letters + "/?=", k=n)))
        else:
            line = [chr(0x4E00 + rnd.randint(0, 2000)) for _ in range(n)]
        changed = list(line)
        changed[next(i for i in range(20, len(line)) if line[i] != " ")] = "x"
        texts += ["".join(line), "".join(changed)]
    want = linked_lines(texts)
    removed = {r.doc_id for r in lines.report(spark.createDataFrame(rows_of(texts), SCHEMA)).collect() if r.n_removed}
    assert len(want) > 100 and removed <= want and len(removed) >= 0.97 * len(want)


def test_links_of_a_bucket_are_complete(spark, monkeypatch):
    """Chains of lines, each similar to its neighbours only, all in one bucket."""
    rnd, texts = random.Random(9), []
    for _ in range(40):
        line = [f"w{rnd.randint(10000, 99999)}" for _ in range(60)]
        for step in range(12):
            line[step * 5 : step * 5 + 5] = [f"w{rnd.randint(10000, 99999)}" for _ in range(5)]
            texts.append(" ".join(line))
    monkeypatch.setattr(lines, "with_bands", lambda every: every.selectExpr("key", "array(1L) as bands").distinct())
    removed = {r.doc_id for r in lines.report(spark.createDataFrame(rows_of(texts), SCHEMA)).collect() if r.n_removed}
    assert removed == linked_lines(texts) and len(removed) == 40 * 11


# -- outliers -------------------------------------------------------------------------------------


def plain_counts(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    found = [x for x in (text or "").split("\n") if x.encode().split()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(found) - len(set(found)), len(covered),
    )


def test_counts_and_verdict(spark, awkward):
    for docs in (documents(spark), awkward):
        texts = {}
        for r in docs.collect():
            texts.setdefault(r.doc_id, []).append(plain_counts(r.text))
        for r in outliers.judged(docs).collect():
            counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            assert counts in texts[r.doc_id]
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.base_failed and r.kept)


def test_outliers_are_rejected(spark):
    rnd = random.Random(8)
    texts = [" ".join("x" * rnd.randint(2, 9) + str(rnd.random()) for _ in range(rnd.randint(80, 300))) for _ in range(300)]
    texts += ["|#$%&* " * 150 + " ".join(str(i) for i in range(40, 400))] * 3
    got = outliers.judged(spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert len(kept & set(range(300))) >= 298 and not kept & {300, 301, 302}


def test_distance_equals_numpy(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(50, 5))
    cov = np.cov(x, rowvar=False, bias=True) + np.diag(np.square(outliers.FLOORS))
    moments = [("g", *map(float, x.mean(0)), *[float(np.cov(x, rowvar=False, bias=True)[i, j]) for i in range(5) for j in range(i, 5)])]
    names = [f"m{i} double" for i in range(5)] + [f"c{i}{j} double" for i in range(5) for j in range(i, 5)]
    estimate = outliers._factor(spark.createDataFrame(moments, "group string, " + ", ".join(names)))
    rows = spark.createDataFrame([("g", *map(float, v)) for v in x], "group string, " + ", ".join(f"x{i} double" for i in range(5)))
    for r in outliers._distances(rows, estimate).collect():
        z = np.array([r[f"x{i}"] for i in range(5)]) - x.mean(0)
        assert r.distance == pytest.approx(z @ np.linalg.inv(cov) @ z)


def test_smallest_determinant_against_all_subsets(spark):
    """Groups of twelve rows, three of them far out: the estimate is that of the best nine rows of all 220 choices."""
    rnd, rows, best = np.random.default_rng(3), [], {}
    floors = np.diag(np.square(outliers.FLOORS))
    for g in range(6):
        x = rnd.normal(size=(12, 5)) * np.array(outliers.FLOORS) * 2
        x[9:] += rnd.choice([-1, 1], size=(3, 5)) * np.array(outliers.FLOORS) * 40
        x = x[rnd.permutation(12)]
        rows += [(f"g{g}", *map(float, v)) for v in x]
        size = lambda c: np.linalg.slogdet(np.cov(x[list(c)], rowvar=False, bias=True) + floors)[1]  # noqa: E731, B023
        chosen = min(itertools.combinations(range(12), 9), key=size)
        best[f"g{g}"] = (size(chosen), x[list(chosen)].mean(0))
    table = spark.createDataFrame(rows, "group string, " + ", ".join(f"x{i} double" for i in range(5)))
    found = outliers.estimates(table)
    assert {r.group for r in found.collect()} == set(best)
    for r in found.join(outliers._factor(found).select("group", outliers._log_determinant().alias("size")), "group").collect():
        assert r["size"] == pytest.approx(best[r.group][0], abs=1e-6)
        assert [r[f"m{i}"] for i in range(5)] == pytest.approx(best[r.group][1])


def test_small_groups_are_judged_by_their_own_centre(spark):
    """A small group of another kind stays, and 99, 100 and 101 rows are judged alike."""
    rnd = random.Random(12)
    words = lambda n: " ".join("x" * rnd.randint(2, 9) + str(rnd.random()) for _ in range(n))
    for n in (20, 99, 100, 101):
        rows = [(i, words(rnd.randint(80, 300)), "en", "s") for i in range(90)]
        rows += [(1000 + i, "".join(f"{k}#$%{rnd.random()}| " for k in range(rnd.randint(80, 300))), "de", "t") for i in range(n)]
        got = outliers.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
        assert sum(r.kept for r in got if r.doc_id >= 1000) >= n - 1
        assert sum(r.kept for r in got if r.doc_id < 1000) >= 88


# -- spots ----------------------------------------------------------------------------------------


def whole_spots(text):
    """The signatures of spots and of the stretches between them."""

    def bare(w):
        kept = [i for i, c in enumerate(w) if unicodedata.category(c)[0] in "LMN"]
        return w[kept[0] : kept[-1] + 1] if kept else w

    words = [bare(w.decode()) for w in text.lower().encode().split()]
    common = [w in set(spots.COMMON) for w in words]
    at = [i for i, c in enumerate(common) if not c]
    after = [words[i - 1] if i and common[i - 1] else None for i in at]
    ahead = [words[i] for i in at[1:]] + [None]
    found = {(a or "|", words[i], n) for k, (i, a, n) in enumerate(zip(at, after, ahead)) if a or not (k and after[k - 1])}
    around = [True, *common, True]
    found |= {("||", w, (words[i + 1 :] or [None])[0]) for i, w in enumerate(words) if all(around[i : i + 3])}
    return found or {text}


def test_spots(spark):
    data = sorted((r.doc_id, r.text) for r in documents(spark).collect())
    got = {r.doc_id: r for r in spots.compared(documents(spark)).collect()}
    jaccard = lambda a, b: len(a & b) / len(a | b)
    for i, (doc_id, text) in enumerate(data):
        after = data[(i + 1) % len(data)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_edited == pytest.approx(jaccard(whole_spots(text), whole_spots(edited)))
        assert r.near_next == pytest.approx(jaccard(whole_spots(text), whole_spots(after)))


def test_spots_of_awkward_rows_and_classes(spark, awkward):
    got = spots.compared(awkward).collect()
    assert len(got) == awkward.count() and all(0 <= r.near_next <= 1 and r.fingerprint for r in got)
    docs = documents(spark)
    data = {r.doc_id: whole_spots(r.text) for r in docs.collect()}
    parent = {d: d for d in data}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in data:
        for b in data:
            if a < b and len(data[a] & data[b]) >= 0.8 * len(data[a] | data[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {(r.doc_id, r.class_id) for r in spots.near_duplicates(docs).collect()} == {(d, root(d)) for d in data}


def test_signatures_cover_the_whole_text(spark):
    rnd = random.Random(3)
    stretch = lambda n: " ".join(f"word{rnd.randint(0, 9999)}" for _ in range(n))
    opening = "and the house stands here"
    first, second = f"{opening} {stretch(300)}", f"{opening} {stretch(300)}"
    edited = first[: len(first) // 2] + stretch(150)
    texts = [first, second, edited, "THE!! house (of, cards) &&& is...", "the house of cards &&& is", "of the", "the", "&&& ***", "", " "]
    texts += [r.text for r in documents(spark).limit(60).collect()]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = {r.i: set(r.own) for r in spots.with_signatures(frame, {"text": "own"}).collect()}
    jaccard = lambda a, b: len(a & b) / len(a | b)
    assert jaccard(got[0], got[1]) < 0.1 and 0.2 < jaccard(got[0], got[2]) < 0.5 and got[3] == got[4]
    sets = [whole_spots(t) for t in texts]
    for a in range(len(texts)):
        assert len(got[a]) == len(sets[a]) > 0
        for b in range(a):
            assert jaccard(got[a], got[b]) == pytest.approx(jaccard(sets[a], sets[b]))


# -- learned operators ----------------------------------------------------------------------------


def test_models_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    docs = docs.join(marks.select("doc_id"), "doc_id", "left_semi")
    for operator, label in ((toxicity, "toxic"), (quality, "quality")):
        model = operator.fit(docs, marks)
        rows = operator.scored(docs, model).where("held_out").join(marks, "doc_id").select("predicted", label).collect()
        assert np.mean([r.predicted == r[label] for r in rows]) > 0.97


def test_models_on_awkward_rows(spark, awkward, empty, labels):
    for operator in (toxicity, quality):
        for marks in (labels, labels.limit(0), labels.where("doc_id % 2 = 0")):
            rows = operator.scored(awkward, operator.fit(awkward, marks)).collect()
            assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.clean(awkward, toxicity.fit(awkward, labels.limit(0))).columns == awkward.columns


def test_isotonic_and_trees():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(400, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    margin = learning.Trees().fit(x, y).margin(x)
    assert np.mean((margin > 0) == y) > 0.97
    steps = learning.Isotonic().fit(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert steps.predict(np.array([0.0, 2, 3, 9])).tolist() == [0, 0.5, 0.5, 1]


def test_secrets(spark):
    key = "AKIA" + "Q7ZK2M5N8P1R4T6V"
    texts = [f'the api token = "{i:04d}a9f3bc7d81e2{i:04d}4c5d" is here and user{i}.name2024@example.com' for i in range(60)]
    texts += [f"see http://example.com/page/{i}/article2024name and 40012345678901{i:02d} ok" for i in range(60)] + [f"{key} of old", None, ""]
    docs = spark.createDataFrame(rows_of(texts), SCHEMA)
    got = secrets.findings(docs).collect()
    secret = {r.value_sha256 for r in got if r.secret}
    assert hashlib.sha256(b"0007a9f3bc7d81e200074c5d").hexdigest() in secret
    assert hashlib.sha256(b"4001234567890107").hexdigest() not in secret
    assert len(secret) <= 61


def test_all_candidates_of_a_word(spark):
    a, b, c = "Zk3v9Qm2Xw7Lp5Tn8R", "Hy6Ud1Se4Gb0Cj9Fa2", "Mq8Wn3Vr5Bt7Kx1Jz6"
    texts = {
        f'{{"x":"{a}","api_key":"{b}","y":"{c}"}}': {a, b, c},
        f"A_TOKEN={a},B_TOKEN={b};{c}": {a, b, c},
        f"eyJhbGciOiJIUzI1NiJ9.{a}.{b}": {"eyJhbGciOiJIUzI1NiJ9", a, b},
        "DB_PASSWORD=abc123!x then": {"abc123!x"},
        "password = letmeinplease now": {"letmeinplease"},
        "Password: hunter2": {"hunter2"},
        "no secret here": set(),
    }
    docs = spark.createDataFrame(rows_of(list(texts)), SCHEMA)
    got = {(r.doc_id, r.value) for r in secrets.candidates(docs).collect()}
    assert got == {(i, v) for i, values in enumerate(texts.values()) for v in values}
    rows = secrets.findings(docs).collect()
    assert len({(r.doc_id, r.place, r.at) for r in rows}) == len(rows) == len(got)


def test_secrets_in_addresses(spark):
    a, b = "Zk3v9Qm2Xw7Lp5Tn8R", "AKIA" + "Q7ZK2M5N8P1R4T6V"
    texts = [f"https://h.org/x?api_key={a}&page=2", f"postgres://user:{a}@host/db", f"see https://h.org/{b}/x", f"https://h.org/author/long2024name{a}", f"write {a}.x@example.com"]
    found = secrets.with_features(secrets.candidates(spark.createDataFrame(rows_of(texts), SCHEMA)))
    got = {(r.doc_id, r.label) for r in secrets.rule_labels(found).collect()}
    assert got == {(0, 1), (1, 1), (2, 1), (3, 0), (4, 0)}


# -- empty tables and the pipeline ----------------------------------------------------------------


def test_empty_tables(spark, empty, labels):
    for result in (
        bpe.encode_decode(empty, VOCABULARY), records.written_and_read(empty, VOCABULARY), simhash.near_duplicates(empty),
        simhash.deduplicated(empty), mixing.mix_report(empty), mixing.mix(empty), lines.report(empty), lines.clean(empty),
        outliers.judged(empty), spots.compared(empty), spots.near_duplicates(empty), secrets.findings(empty),
        toxicity.scored(empty, toxicity.fit(empty, labels)), quality.scored(empty, quality.fit(empty, labels)),
    ):
        assert result.count() == 0


def test_stages_on_awkward_rows(spark, awkward):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == awkward.columns, name
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert tokens.count() == docs.count()


def test_pipeline(spark, library):
    """The run equals its stages one by one, its tokens those of the library."""
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want[(r.doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())] += 1
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter(tuple(r)[:3] for r in got) == want and sum(want.values()) > 50
