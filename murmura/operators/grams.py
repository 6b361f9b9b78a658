"""N-grams counted and weighed over whole Arrow batches.

The words of a text come as one string with blanks between them (`functions.text.words`). The words of many texts are
cut and numbered at once, n-grams are pairs of numbers, and all counting is done on numbers: no n-gram is put together
as text for every place where it stands. Spark spreads the batches and adds up what each of them counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut and numbered together; a longer text makes a piece of its own.
PIECE = 8 << 20

COUNTS = "term string, df bigint, cf bigint"


@dataclass
class Grams:
    """The n-grams of some texts of one size.

    ``code`` has, for each word, the place in ``terms`` of the n-gram that begins there, -1 for none, and ``row`` its
    text. ``last`` has the place in ``words`` of the last word of each term.
    """

    row: np.ndarray
    code: np.ndarray
    terms: pa.Array
    last: np.ndarray
    words: pa.Array


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PIECE, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def cut(texts: pa.Array) -> Grams:
    """The words of two or more characters."""
    listed = pc.split_pattern(texts, " ")
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
    coded = listed.flatten().dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    several = pc.greater(pc.utf8_length(words), 1).to_numpy(zero_copy_only=False)[code]
    return Grams(row[several], code[several], words, np.arange(len(words)), words)


def _among(terms: pa.Array, chosen: pa.Array | None) -> np.ndarray:
    if chosen is None:
        return np.ones(len(terms), bool)
    return pc.is_in(terms, value_set=chosen).to_numpy(zero_copy_only=False)


def longer(grams: Grams, heads: pa.Array | None = None, tails: pa.Array | None = None) -> Grams:
    """The n-grams one word longer; with ``heads`` or ``tails`` only those that begin or end with one of them."""
    size = len(grams.terms)
    if not size:
        return grams
    begin, end = grams.code[:-1], grams.code[1:]
    there = (begin >= 0) & (end >= 0) & (grams.row[:-1] == grams.row[1:])
    at = np.flatnonzero(there & _among(grams.terms, heads)[begin] & _among(grams.terms, tails)[end])
    coded = pa.array(begin[at] * size + end[at]).dictionary_encode()
    begins, ends = np.divmod(coded.dictionary.to_numpy(), size)
    last = grams.last[ends]
    terms = pc.binary_join_element_wise(grams.terms.take(pa.array(begins)), grams.words.take(pa.array(last)), " ")
    code = np.full(len(grams.code), -1, np.int64)
    code[at] = coded.indices.to_numpy()
    return Grams(grams.row, code, terms, last, grams.words)


def counts(grams: Grams) -> pa.RecordBatch:
    """Document and corpus frequency of the n-grams of some texts."""
    size, there = max(len(grams.terms), 1), grams.code >= 0
    code, row = grams.code[there], grams.row[there]
    cf = np.bincount(code, minlength=len(grams.terms))
    once = pa.array(row * size + code).unique().to_numpy() % size
    df = np.bincount(once, minlength=len(grams.terms))
    seen = np.flatnonzero(cf)
    return pa.RecordBatch.from_arrays(
        [grams.terms.take(pa.array(seen)), pa.array(df[seen], pa.int64()), pa.array(cf[seen], pa.int64())], ["term", "df", "cf"]
    )


def counting(n: int, parts: list[str] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of words to `COUNTS` of their n-grams, with ``parts`` only of those whose (n-1)-grams are among them."""
    known = None if parts is None else pa.array(parts, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in pieces(batch.column(0)):
                grams = cut(texts)
                for size in range(2, n + 1):
                    grams = longer(grams, known, known) if size == n else longer(grams)
                yield counts(grams)

    return run


def _parts(terms: list[str], n: int) -> tuple[pa.Array, pa.Array]:
    """What the n-grams begin and end with that ``terms``, or longer terms of them, have in them."""
    split = [t.split(" ") for t in terms]
    inside = {tuple(words[i : i + n]) for words in split for i in range(len(words) - n + 1)}
    return tuple(pa.array(sorted({" ".join(p) for p in part}), pa.string()) for part in ({g[:-1] for g in inside}, {g[1:] for g in inside}))


#: Rows of a batch that goes back.
ROWS = 1 << 16

Cells = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _weighing(terms: list[str], idf: list[float], min_n: int, max_n: int) -> Callable[[pa.Array], Cells]:
    """Texts to cells in the order of texts and ``terms``: text, term, occurrences and weight, and the norm of each text."""
    vocabulary, weight = pa.array(terms, pa.string()), np.array(idf)
    parts = {n: _parts(terms, n) for n in range(2, max_n + 1)}

    def places(grams: Grams) -> np.ndarray:
        """Text and term of each n-gram in the vocabulary, as one number."""
        found = pc.fill_null(pc.index_in(grams.terms, value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(grams.code >= 0)
        index = found[grams.code[at]].astype(np.int64)
        return (grams.row[at] * len(terms) + index)[index >= 0]

    def one(texts: pa.Array) -> Cells:
        grams, listed = cut(texts), []
        for n in range(1, max_n + 1):
            grams = longer(grams, *parts[n]) if n > 1 else grams
            if n >= min_n:
                listed.append(places(grams))
        cells, tf = np.unique(np.concatenate(listed), return_counts=True)
        row, index = np.divmod(cells, len(terms))
        weights = tf * weight[index]
        return row, index, tf, weights, np.sqrt(np.bincount(row, weights * weights, len(texts)))

    return one


def strength(terms: list[str], idf: list[float], min_n: int, max_n: int) -> Callable[[pa.Array], pa.Array]:
    """The words of texts to the sums of their L2-normalised weights, added up in the order of ``terms``."""
    weigh = _weighing(terms, idf, min_n, max_n)

    def one(texts: pa.Array) -> np.ndarray:
        row, _, _, weights, norm = weigh(texts)
        total = np.bincount(row, weights, len(texts))
        return np.divide(total, norm, out=np.zeros(len(texts)), where=norm > 0)

    return lambda words: pa.array(np.concatenate([np.zeros(0), *map(one, pieces(words))]))


def _by_text(
    cells: Callable[[pa.Array], tuple[np.ndarray, dict[str, pa.Array]]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of a key and words to rows of the key and of what ``cells`` finds in the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for texts in pieces(batch.column(1)):
                row, found = cells(texts)
                key = batch.column(0).slice(start, len(texts))
                start += len(texts)
                for at in range(0, len(row), ROWS):
                    part = {name: column.slice(at, ROWS) for name, column in found.items()}
                    yield pa.RecordBatch.from_pydict({batch.schema.names[0]: key.take(pa.array(row[at : at + ROWS])), **part})

    return run


def weights(terms: list[str], idf: list[float], min_n: int, max_n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A key and words to the key, ``term``, ``tf`` and L2-normalised ``weight`` of each term of the vocabulary in them."""
    weigh, vocabulary = _weighing(terms, idf, min_n, max_n), pa.array(terms, pa.string())

    def cells(texts: pa.Array) -> tuple[np.ndarray, dict[str, pa.Array]]:
        row, index, tf, weights, norm = weigh(texts)
        return row, {"term": vocabulary.take(pa.array(index)), "tf": pa.array(tf, pa.int64()), "weight": pa.array(weights / norm[row])}

    return _by_text(cells)


def occurrences(min_n: int, max_n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A key and words to the key, ``term`` and ``tf`` of each different n-gram of the words."""

    def cells(texts: pa.Array) -> tuple[np.ndarray, dict[str, pa.Array]]:
        grams, sizes = cut(texts), []
        for n in range(1, max_n + 1):
            grams = longer(grams) if n > 1 else grams
            if n >= min_n:
                sizes.append(grams)
        starts = np.cumsum([0, *(len(g.terms) for g in sizes)])
        placed = [g.row[g.code >= 0] * starts[-1] + start + g.code[g.code >= 0] for g, start in zip(sizes, starts)]
        found, tf = np.unique(np.concatenate(placed), return_counts=True)
        row, code = np.divmod(found, max(starts[-1], 1))
        terms = pa.concat_arrays([g.terms for g in sizes])
        return row, {"term": terms.take(pa.array(code)), "tf": pa.array(tf, pa.int64())}

    return _by_text(cells)
