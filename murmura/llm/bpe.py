"""Byte-pair encoding and decoding as streaming transducers with bounded memory.

A prefix of a text fixes its first tokens once enough of what follows is known. How much is enough
follows from the merge list alone (:func:`sufficient_lookahead`): a token's right edge can only be
moved by a merge of higher priority on its right, that one by a still higher one, and so on, so the
longest such chain bounds what has to be seen. The encoder keeps at most one chunk plus that
lookahead, whatever the length of the text; the decoder keeps the bytes of one unfinished character.

Cases: a null text counts as empty and has no tokens; ids of documents may be null or repeat, each row
is encoded by itself; further columns, whatever their names, are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import sys
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from murmura.llm.common import whole

#: Code points read into the transducer at a time.
CHUNK = 1 << 16
#: A unit (word with its punctuation) longer than this is encoded piece by piece, not looked up.
LONG_UNIT = 256
#: Entries of the memo of units; it is emptied when full.
MEMO = 600_000

# Letters and digits of Unicode 16.0 that Python's 15.1 tables lack, as (first, last).
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
NUMBERS_16 = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
#: Fixed value: white space of Unicode.
SPACE = r"\t-\r\x20\x85\xa0  -     　"


def _category(initial: str, more: tuple[tuple[int, int], ...]) -> str:
    """The body of a character class: all code points whose category starts with ``initial``."""
    spans: list[list[int]] = []
    for point in range(sys.maxunicode + 1):
        if unicodedata.category(chr(point))[0] == initial:
            if spans and spans[-1][1] == point - 1:
                spans[-1][1] = point
            else:
                spans.append([point, point])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in [*spans, *more])


def piece_pattern() -> re.Pattern:
    """Splits text into the pieces that merges never cross."""
    letter, number = _category("L", LETTERS_16), _category("N", NUMBERS_16)
    return re.compile(
        rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+"
        rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token's end that settle where the token ends, for any text."""
    fires: dict[bytes, int] = defaultdict(int)  # bytes that settle whether some merge so far takes this token
    forms: dict[bytes, int] = defaultdict(int)  # bytes after a token that settle that it forms
    for left, right in merges:
        after = max(forms[right], fires[right])
        forms[left + right] = max(forms[left + right], after)
        fires[left] = max(fires[left], len(right) + after)
    return max([0, *forms.values(), *fires.values()])


class Model:
    """A byte-level merge list with its ids and special strings."""

    def __init__(self, text: str):
        spec = json.loads(text)
        alphabet = byte_alphabet()
        spell = lambda token: bytes(alphabet[c] for c in token)
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        vocabulary = {spell(t): i for t, i in spec["model"]["vocab"].items()}
        merges = [(spell(a), spell(b)) for a, b in pairs]
        self.byte_ids = [vocabulary[bytes([b])] for b in range(256)]
        self.ranks = {(vocabulary[a], vocabulary[b]): rank for rank, (a, b) in enumerate(merges)}
        self.made = [vocabulary[a + b] for a, b in merges]
        self.lookahead = sufficient_lookahead(merges)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes = {i: b for b, i in vocabulary.items()} | {i: t.encode() for t, i in self.special.items()}
        self.special_pattern = (
            re.compile("|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)))
            if self.special
            else None
        )
        self.longest_special = max([1, *map(len, self.special)])
        self.pieces = piece_pattern()
        self.units: dict[str, bytes] = {}
        self.memo: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """Tokens of one piece: the best-ranked pair is joined, leftmost first, until none is left."""
        ids = [self.byte_ids[b] for b in data]
        find, made, none = self.ranks.get, self.made, len(self.made)
        ranks = [find(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            at = ranks.index(best)
            ids[at : at + 2] = [made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = find((ids[at - 1], ids[at]), none)
            if at < len(ranks):
                ranks[at] = find((ids[at], ids[at + 1]), none)
        return ids

    def unit(self, text: str) -> bytes:
        """Ids of a short run of text with nothing that continues into its neighbours."""
        memo, out = self.memo, []
        for piece in self.pieces.findall(text):
            ids = memo.get(piece)
            if ids is None:
                if len(memo) >= MEMO:
                    memo.clear()
                ids = memo[piece] = array("I", self.merge(piece.encode())).tobytes()
            out.append(ids)
        return b"".join(out)


class Encoder:
    """Feed text in chunks; each call returns the ids that are stable by then, 4 bytes each."""

    def __init__(self, model: Model):
        self.model = model
        self.text = ""  # not encoded yet
        self.piece: bytes | None = None  # bytes of a long piece whose end is not in sight
        self.kind = ""  # and what it runs over

    def feed(self, chunk: str) -> bytes:
        return self._advance(chunk, last=False)

    def finish(self) -> bytes:
        return self._advance("", last=True)

    def _advance(self, chunk: str, last: bool) -> bytes:
        self.text += chunk
        out: list[bytes] = []
        model = self.model
        while model.special_pattern and (hit := model.special_pattern.search(self.text)):
            rest, self.text = self.text[hit.end() :], self.text[: hit.start()]
            self._plain(out, last=True)
            out.append(model.special[hit.group()].to_bytes(4, "little"))
            self.text = rest
        self._plain(out, last)
        return b"".join(out)

    def _plain(self, out: list[bytes], last: bool) -> None:
        """Encode the text, which holds no whole special string, as far as it is stable."""
        if last:
            self._units(out, self.text)
            self.text = ""
            return
        # What could still become a special string or be changed by the next characters stays.
        safe = len(self.text) - model_margin(self.model)
        cut = self.text.rfind(" ", 0, safe)
        while cut > 0 and self.text[cut + 1].isspace():
            cut = self.text.rfind(" ", 0, cut)
        if cut > 0 and self.piece is None:
            head, self.text = self.text[:cut], self.text[cut:]
            self._units(out, head)
        if len(self.text) - model_margin(self.model) > LONG_UNIT or self.piece is not None:
            self.text = self._pieces(out, self.text, whole=False)

    def _units(self, out: list[bytes], text: str) -> None:
        """Encode text that nothing after it can change, unit by unit."""
        if self.piece is not None:
            self._pieces(out, text, whole=True)
            return
        model = self.model
        if not text:
            return
        first, *rest = text.split(" ")
        units = [first] if first else []
        for part in rest:  # a blank before a word opens a unit; blanks before blanks do not
            if part and not part[0].isspace():
                units.append(" " + part)
            elif units:
                units[-1] += " " + part
            else:
                units.append(" " + part)
        memo = model.units
        for unit in units:
            ids = memo.get(unit)
            if ids is None:
                if len(unit) > LONG_UNIT:
                    self._pieces(out, unit, whole=True)
                    continue
                if len(memo) >= MEMO:
                    memo.clear()
                ids = memo[unit] = model.unit(unit)
            out.append(ids)

    def _pieces(self, out: list[bytes], text: str, whole: bool) -> str:
        """Encode piece by piece; the last piece, if it may go on, byte by byte behind the lookahead.

        Returns what is not stable yet.
        """
        model = self.model
        end = len(text) if whole else len(text) - model_margin(model)
        at = 0
        while at < len(text):
            hit = model.pieces.match(text, at)
            if self.piece is not None:  # the text continues the piece that is open
                stop = _run_end(model, self.kind, text, at)
            else:
                stop = hit.end()
            if stop <= end and (whole or stop < end):
                self._bytes(out, text[at:stop].encode(), ended=True)
                at = stop
                continue
            if stop - at > LONG_UNIT or self.piece is not None:  # long: take in what is safe
                take = max(at, min(stop, end))
                if take > at:
                    if self.piece is None:
                        self.kind = _kind(model, text[at:take])
                    self._bytes(out, text[at:take].encode(), ended=False)
                    at = take
            break
        if whole and self.piece is not None:
            self._bytes(out, b"", ended=True)
        return text[at:]

    def _bytes(self, out: list[bytes], data: bytes, ended: bool) -> None:
        model = self.model
        held = (self.piece or b"") + data
        step = 4 * model.lookahead + 64
        at = 0
        while len(held) - at > step:  # windows of constant size: what ends before the lookahead is stable
            for token in model.merge(held[at : at + step]):
                size = len(model.token_bytes[token])
                if size > step - model.lookahead:
                    break
                step_left = at + size
                out.append(token.to_bytes(4, "little"))
                at = step_left
                step -= size
            step = 4 * model.lookahead + 64
        if ended:
            out += [t.to_bytes(4, "little") for t in model.merge(held[at:])]
            self.piece = None
        else:
            self.piece = held[at:]


def model_margin(model: Model) -> int:
    """Characters at the end of what is known that may still change how the text splits."""
    return model.longest_special + 3


#: A character of each class: letters, digits, other marks, blanks.
SAMPLES = "a1-\t"


def _kind(model: Model, text: str) -> str:
    """The sample of the class of characters that the open piece runs over."""
    return next(c for c in SAMPLES if model.pieces.fullmatch(c + text[-1]))


def _run_end(model: Model, kind: str, text: str, at: int) -> int:
    """Where a run that goes on at ``at`` ends."""
    return at + model.pieces.match(kind + text[at:]).end() - 1


class Decoder:
    """Turns ids into text as they come; holds back only the bytes of an unfinished character."""

    def __init__(self, model: Model):
        self.token_bytes = model.token_bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes) -> str:
        look = self.token_bytes
        return self.state.decode(b"".join([look[i] for i in memoryview(ids).cast("I")]))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


_MODELS: dict[str, Model] = {}


def model_of(text: str) -> Model:
    """One model a process for each vocabulary; ids and memo are shared by its tasks."""
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _MODELS:
        _MODELS[key] = Model(text)
    return _MODELS[key]


def round_trip(model: Model, text: str) -> tuple[int, str, str]:
    """Count and digest of the ids, and digest of the text decoded from them, in constant memory."""
    encoder, decoder = Encoder(model), Decoder(model)
    ids_digest, text_digest, n = hashlib.sha256(), hashlib.sha256(), 0

    def put(ids: bytes) -> None:
        nonlocal n
        n += len(ids) // 4
        ids_digest.update(ids)
        text_digest.update(decoder.feed(ids).encode())

    for at in range(0, len(text), CHUNK):
        put(encoder.feed(text[at : at + CHUNK]))
    put(encoder.finish())
    text_digest.update(decoder.finish().encode())
    return n, ids_digest.hexdigest(), text_digest.hexdigest()


def vocabulary_text(spark: SparkSession, path: str) -> str:
    """The vocabulary file, read by Spark if the path names a file system, else from the driver's disk."""
    if "://" in path:
        return "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per row: ``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``. Map-only.

    ``vocabulary`` is the path of a byte-level BPE file; its text, of a few MB whatever the corpus, goes
    to the executors as a broadcast.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(vocabulary_text(spark, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(spec.value)
        for batch in batches:
            results = [round_trip(model, t.as_py()) for t in batch.column(1)]
            columns = list(zip(*results)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.string()),
                    pa.array(columns[2], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), whole(docs[text]).alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
