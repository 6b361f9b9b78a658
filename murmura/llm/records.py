"""Token ids as length-delimited binary records, with a separate offset index.

A record is ``length (u64), masked checksum of the length (u32), payload, masked checksum of the payload
(u32), newline``, all little-endian; checksums are CRC-32, masked as below so that a checksum stored
inside a payload does not fit itself. A payload is ``id flag (u8), doc_id (i64), bytes per token id
(u8), token ids``. Spark's text writer puts down one record a row, so the files are committed as any
other table: a retried or duplicated task leaves no half file, on any file system Spark can write to.

Files follow each other in ascending order of ``doc_id``; the number of files grows with the text, not
their size. The index, a table beside the files, has file, position and size of each record, so that readers
can fetch records in any order.

Cases: a null text counts as empty, its record holds the end id alone; null ids come first; rows that
repeat an id follow each other, ordered by their text; further columns are not read. An empty table
gives no records and an empty index.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from murmura.llm.bpe import vocabulary_text
from murmura.llm.common import whole
from murmura.storage import scratch_path

END_ID = 0
#: Bytes of text that one file of records is made of, about: more text makes more files, not larger ones.
FILE_BYTES = 64 << 20
HEAD = struct.Struct("<QI")
PAYLOAD = struct.Struct("<BqB")
#: Entries of a worker's memo of encoded pieces, and their characters; a full one is emptied.
MEMO, MEMO_CHARS = 600_000, 8 << 20
#: Bytes of text that a worker cuts at once, and new pieces that the library gets as one text.
TOGETHER, RUN = 3 << 20, 2_000
#: The mark between units while they are cut, the plain signs, digits and line end, and (a fixed value) all blanks.
MARK = "\0"
SIGNS = r"!-&(-@\[-`{-~\n"
BLANKS = r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

INDEX = "file string, doc_id long, position long, size long, n_tokens long, before long, ids_crc32 long"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def record(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    """A record without its newline, which the writer puts."""
    payload = PAYLOAD.pack(doc_id is not None, doc_id or 0, width) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<Q", len(payload))
    return HEAD.pack(len(payload), masked(length)) + payload + struct.pack("<I", masked(payload))


def parse(content: bytes) -> Iterator[tuple[int | None, int, int, np.ndarray]]:
    """``doc_id``, position, size and ids of each record; raises where a checksum does not fit."""
    view, at = memoryview(content), 0
    while at < len(view):
        length, crc = HEAD.unpack_from(view, at)
        if masked(bytes(view[at : at + 8])) != crc:
            raise ValueError(f"damaged length at byte {at}")
        start = at + HEAD.size
        payload = view[start : start + length]
        (crc,) = struct.unpack_from("<I", view, start + length)
        if masked(payload) != crc:
            raise ValueError(f"damaged record at byte {at}")
        known, doc_id, width = PAYLOAD.unpack_from(payload)
        ids = np.frombuffer(payload, f"<u{width}", offset=PAYLOAD.size)
        size = HEAD.size + length + 5
        yield (doc_id if known else None), at, size, ids
        at += size


class LibraryEncoder:
    """The tokenizers library, asked once for each different piece of a worker's texts.

    A unit starts at a blank that comes right before something other than a blank, and is cut once more
    behind each plain letter that a plain sign, digit or line end follows. No token spans those places, so the
    ids of a text are those of its pieces one after another. Arrow cuts and numbers the different units, and of
    those the different pieces; pieces not met before are written one after another for the library, and the
    ids that come back are told apart by the bytes their tokens stand for. Texts that hold a special string
    or the mark that cuts go to the library whole.
    """

    def __init__(self, spec: str):
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.whole = "|".join(re.escape(s) for s in [MARK, *special])
        self.size = np.zeros(self.library.get_vocab_size(), "<i4")
        for token, i in self.library.get_vocab().items():
            self.size[i] = len(token)  # one character a byte
        self.tail = re.compile(f"[{SIGNS}]")
        self.memo: dict[str, bytes] = {}
        self.held = 0

    def _ask(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The library's ids of whole texts, few at a time: its own results are large."""
        for at in range(0, len(texts), 4):
            for found in self.library.encode_batch_fast(texts[at : at + 4], add_special_tokens=False):
                yield np.array(found.ids, dtype="<u4")

    def _learn(self, pieces: list[str]) -> None:
        """Put the ids of new pieces into the memo."""
        row, alone = [], []
        for piece in pieces:
            if piece[:1] == " " and len(piece) > 1 and not piece[1].isspace():
                row.append(piece)
            elif self.tail.match(piece):
                row += (" a", piece)
            else:
                alone.append(piece)
        runs = [row[at : at + RUN] for at in range(0, len(row), RUN)]
        for i, run in enumerate(runs):
            if self.tail.match(run[0]):  # its letter ended the run before
                runs[i] = [" a", *run]
        for run, ids in zip(runs, self._ask(["".join(run) for run in runs])):
            ends = np.cumsum([len(piece.encode()) for piece in run])
            told = np.cumsum(self.size[ids])
            cuts = np.searchsorted(told, ends) + 1
            if told[-1] != ends[-1] or (told[cuts - 1] != ends).any():
                raise ValueError("tokens of this vocabulary do not keep to pieces")
            data, cuts = ids.tobytes(), [0, *(4 * cuts).tolist()]
            self.memo.update(zip(run, (data[x:y] for x, y in zip(cuts, cuts[1:]))))
        self.memo.update(zip(alone, (ids.tobytes() for ids in self._ask(alone))))
        self.held += sum(map(len, pieces))

    def _pieces(self, units: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units one after another, and where each one's start and end."""
        lists = pc.split_pattern(pc.replace_substring_regex(units, f"([A-Za-z])([{SIGNS}])", r"\1" + MARK + r"\2"), MARK)
        numbered = lists.flatten().dictionary_encode()
        distinct = numbered.dictionary.to_pylist()
        if len(self.memo) > MEMO or self.held > MEMO_CHARS:
            self.memo.clear()
            self.held = 0
        self._learn([piece for piece in distinct if piece not in self.memo])
        known = list(map(self.memo.__getitem__, distinct))
        bounds = np.cumsum([0, *map(len, known)]) // 4
        return spread(np.frombuffer(b"".join(known), "<u4"), bounds, numbered, lists)

    def encode(self, texts: pa.StringArray | list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        apart = pc.match_substring_regex(texts, self.whole)
        doubled = pc.match_substring_regex(texts, f" [{BLANKS}]")
        marked = pc.replace_substring(texts, " ", MARK + " ")
        if pc.any(doubled).as_py():
            single = pc.replace_substring_regex(texts, f" ([^{BLANKS}])", MARK + r" \1")
            marked = pc.if_else(doubled, single, marked)
        lists = pc.split_pattern(pc.if_else(apart, "", marked), MARK)
        numbered = lists.flatten().dictionary_encode()
        ids, bounds = spread(*self._pieces(numbered.dictionary), numbered, lists)
        out = [ids[x:y] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        places = np.flatnonzero(apart).tolist()
        for place, found in zip(places, self._ask([texts[i].as_py() for i in places])):
            out[place] = found
        return out


def spread(ids: np.ndarray, bounds: np.ndarray, numbered: pa.DictionaryArray, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and bounds of ``lists`` from those of their different members, which are ``numbered``."""
    of = numbered.indices.to_numpy()
    counts = np.diff(bounds)[of]
    ends = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
    places = np.repeat((bounds[of] - ends[:-1]).astype("<i4"), counts)  # a text is below 2 GB
    places += np.arange(ends[-1], dtype="<i4")
    found = ids[places]
    offsets = lists.offsets.to_numpy()
    return found, ends[offsets - offsets[0]]


_ENCODERS: dict[int, LibraryEncoder] = {}


def encoder_of(spec: str) -> LibraryEncoder:
    """One encoder a process for each vocabulary."""
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS[key] = LibraryEncoder(spec)
    return _ENCODERS[key]


def slices(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Places and numbers of rows that are encoded together: up to ``TOGETHER`` bytes, or one text."""
    sums = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = sums[at - 1] if at else 0
        n = max(1, int(np.searchsorted(sums, before + TOGETHER, "right")) - at)
        yield at, n
        at += n


def n_files(docs: DataFrame) -> int:
    """Files of records: so many that one is made of about ``FILE_BYTES``, of little text four for each core."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(size // FILE_BYTES + 1, min(size // (FILE_BYTES // 8) + 1, 4 * cores))


def write_records(docs: DataFrame, vocabulary: str, folder: str) -> None:
    """Encode and write all documents in ascending order of ``doc_id``, then their index beside them."""
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(vocabulary_text(spark, vocabulary))
    end = np.array([END_ID], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(spec.value)
        width = 2 if encoder.library.get_vocab_size() <= 1 << 16 else 4
        for batch in batches:
            texts = batch.column(1).cast(pa.string())
            for at, n in slices(texts):
                encoded = encoder.encode(texts.slice(at, n))
                frames = [
                    record(doc_id, np.concatenate([ids, end]), width)
                    for doc_id, ids in zip(batch.column(0).slice(at, n).to_pylist(), encoded)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["record"])
                pa.default_memory_pool().release_unused()

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole(docs["text"]).alias("text"))
    ordered = chosen.repartitionByRange(n_files(chosen), F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text"
    )
    ordered.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value")).write.text(folder)
    scan(spark, folder).write.parquet(index_folder(folder))


def index_folder(folder: str) -> str:
    return folder.rstrip("/") + "-index"


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index that lies beside the records."""
    return spark.read.schema(INDEX).parquet(index_folder(folder))


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """The offset index, read from the record files themselves; every checksum is compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, before = [], 0
                for doc_id, at, size, ids in parse(content.as_buffer()):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((path.rsplit("/", 1)[-1], doc_id, at, size, len(ids), before, crc))
                    before += len(ids)
                columns = list(zip(*rows)) or [()] * 7
                types = [pa.string(), *[pa.int64()] * 6]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    ["file", "doc_id", "position", "size", "n_tokens", "before", "ids_crc32"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(run, INDEX)


def with_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids in all records before: sums per file, then over the files."""
    ends = index.groupBy("file").agg(F.sum("n_tokens").alias("in_file"))
    # By number: names are padded to five digits, and sort wrongly from the hundred thousandth file on.
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    order = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("file", F.coalesce(F.sum("in_file").over(order), F.lit(0)).alias("file_start"))
    return index.join(starts, "file").withColumn("start", F.col("file_start") + F.col("before")).drop("file_start")


def written_and_read(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Write the records and their index, and report each document as the files have it."""
    folder = scratch_path(docs.sparkSession, "llm-records")
    write_records(docs, vocabulary, folder)
    return with_starts(read_index(docs.sparkSession, folder)).select("doc_id", "start", "n_tokens", "ids_crc32", "position", "size")


def shuffled(spark: SparkSession, folder: str, index: DataFrame, seed: int) -> DataFrame:
    """``doc_id`` and ids in an order drawn by ``seed``: the index is shuffled, then records are fetched by it."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                data = memoryview(content.as_buffer())
                rows = [
                    (x["place"], doc_id, ids.tolist())
                    for x in wanted
                    for doc_id, _, _, ids in parse(data[x["position"] : x["position"] + x["size"]])
                ]
                columns = list(zip(*rows)) or [(), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.list_(pa.int64()))],
                    ["place", "doc_id", "ids"],
                )

    wanted = index.groupBy("file").agg(  # as many as a file holds
        F.collect_list(F.struct("position", "size", F.xxhash64(F.lit(seed), "file", "position").alias("place"))).alias("wanted")
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return (
        files.join(wanted, "file")
        .select("content", "wanted")
        .mapInArrow(fetch, "place long, doc_id long, ids array<long>")
        .orderBy("place")
        .drop("place")
    )
