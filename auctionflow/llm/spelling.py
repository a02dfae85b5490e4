"""Spelling variants: words one edit apart, by dense tiles of padded code-point matrices.

Two words are near if exactly one inserted, deleted or replaced code point turns one into the other; then their common
prefix and common suffix together reach the longer length minus one.

Which words meet: let a be the shorter length of a pair, cut into three parts.  The edit lies in one part, and what is left
without it is equal in both words (after an insertion the later parts stand one place further on).  So each word goes into
six blocks, by length (a or a + 1) and part left out, and all its near words share a block with it.  Blocks are cut into
tiles by hash; the words of each pair of tiles are compared as matrices of code points, so a large block spreads over tasks
and only near words leave it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.llm.shared import staged, texts, tidy

#: Fixed by the operator's contract: a run of Latin letters, all code points below 256.
RUN = re.compile("[A-Za-zÀ-ÿ]+")

#: Words of a tile, and cells (pairs of words) that are compared at once.
TILE, CELLS = 512, 2_000_000

# --- words -----------------------------------------------------------------------


def variant(doc: str, run: str, every: int = 97) -> str:
    """``run`` with one code point deleted if ``every`` divides the CRC-32 of "doc:run"."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def counted_runs(text: str) -> Counter:
    """How often each maximal run of letters (A-Z lower-cased) occurs in the whole text."""
    low = text.encode().lower().decode()
    # a list of all runs of a very long text would need many times its size
    return Counter(RUN.findall(low) if len(low) < 1_000_000 else (m[0] for m in RUN.finditer(low)))


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int = 97) -> DataFrame:
    """word and n (occurrences in all texts) of the words of at least ``least_length`` code points and ``least_count``
    occurrences.  Null texts have no words; a missing doc_id reads as empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                for run, n in counted_runs(text).items():
                    if len(run) >= least_length:
                        word = variant(doc, run, every)
                        if len(word) >= least_length:
                            found[word] += n
                if len(found) > 200_000:
                    yield out()
                    found.clear()
        yield out()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(tidy(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


# --- near words ------------------------------------------------------------------


def _blocks() -> Column:
    """The six blocks of ``word``: a, part left out, is it the longer length, and what is equal in near words."""
    size, found = F.length("word"), []
    for longer in (0, 1):
        a = size - longer
        first, second = F.floor(a / 3).cast("int"), F.floor(2 * a / 3).cast("int")
        left, right = (lambda n: F.substr("word", F.lit(1), n)), (lambda n, r=longer: F.substr("word", n + r + 1))
        for part, rest in enumerate((right(first), F.concat(left(first), F.lit(" "), right(second)), left(second))):
            found.append(F.struct(a.alias("a"), F.lit(part).alias("part"), F.lit(longer).alias("longer"), rest.alias("rest")))
    return F.array(*found)


def tile_pairs(words: DataFrame) -> DataFrame:
    """word, n, a, part, longer, tile and the pair of tiles (rest, i, j) of every word that may have a near word."""
    rows = words.select("word", "n", F.explode(_blocks()).alias("b")).select("word", "n", "b.*")
    block = ["a", "part", "rest"]
    sizes = rows.groupBy(*block).agg(F.count("*").alias("size"), F.min("longer").alias("least")).where("size > 1 and least = 0")
    rows = rows.join(sizes.select(*block, F.ceil(F.col("size") / TILE).cast("int").alias("tiles")), block)
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("word"), "tiles").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return rows.select("word", "n", *block, "longer", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))


def near_cells(codes: np.ndarray, back: np.ndarray, longer: np.ndarray, tile: np.ndarray, a: np.ndarray, part: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Which cells (g, u, v) hold near words u and v of group g, each pair once.

    codes: (groups, words, width) code points from the front, 0 where a word has ended; back: the same from the end;
    longer: 0 for words of length a, 1 for a + 1, 2 for empty places; apart: only words of different tiles are compared.
    """

    def common(x: np.ndarray) -> np.ndarray:
        alive = np.ones(x.shape[:2] + x.shape[1:2], dtype=bool)
        size = np.zeros(alive.shape, dtype=np.int16 if x.shape[2] < 30_000 else np.int32)
        for at in range(x.shape[2]):
            alive &= x[:, :, None, at] == x[:, None, :, at]
            if not alive.any():
                break
            size += alive
        return size

    prefix, suffix = common(codes), common(back)
    a, part = a[:, None, None], part[:, None, None]
    short, long_ = (longer == 0), (longer == 1)
    n = codes.shape[1]
    same = short[:, :, None] & short[:, None, :] & np.triu(np.ones((n, n), dtype=bool), 1) & (prefix + suffix >= a - 1)
    more = short[:, :, None] & long_[:, None, :] & (prefix + suffix >= a)
    # an insertion into equal letters fits several places: it counts in the block of the first part that fits
    more &= part == (a - suffix > a // 3).astype(np.int8) + (a - suffix > 2 * a // 3)
    found = same | more
    return found & ((tile[:, :, None] != tile[:, None, :]) | ~apart[:, None, None])


def _matrix(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    make = lambda items: np.array(items, dtype=f"S{width}").view(np.uint8).reshape(len(items), width)
    return make(words), make([w[::-1] for w in words])


def near_in_groups(words: list[bytes], starts: np.ndarray, longer: np.ndarray, tile: np.ndarray, a: np.ndarray, part: np.ndarray,
                   apart: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers that hold near words.  Rows starts[g] to starts[g + 1] are group g; a, part and apart are by
    group.  Groups of like size and word length are compared together, padded to the same size."""
    sizes = np.diff(starts)
    height = np.where(sizes > 64, -(-sizes // 64) * 64, 2 ** np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64))
    width = 8 * (a // 8 + 1)  # holds a + 1 code points
    kinds = height * 2 ** 32 + width
    for kind in np.unique(kinds):
        of_kind = np.flatnonzero(kinds == kind)
        h, w = int(kind >> 32), int(kind & (2 ** 32 - 1))
        step = max(1, CELLS // (h * max(h, w)))
        for k in range(0, len(of_kind), step):
            groups = of_kind[k:k + step]
            place = starts[groups][:, None] + np.arange(h)
            there = np.arange(h) < sizes[groups][:, None]
            rows = place[there]
            codes, back = np.zeros((2, len(groups), h, w), dtype=np.uint8)
            codes[there], back[there] = _matrix([words[r] for r in rows.tolist()], w)
            kind_of, tiles = np.full(place.shape, 2, dtype=np.int8), np.zeros(place.shape, dtype=np.int64)
            kind_of[there], tiles[there] = longer[rows], tile[rows]
            g, u, v = np.nonzero(near_cells(codes, back, kind_of, tiles, a[groups], part[groups], apart[groups]))
            yield place[g, u], place[g, v]


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near and the near word (best) of largest n (best_n; ties: the smallest), of the words that have near words."""
    rows = tile_pairs(words)
    group = ["a", "part", "rest", "i", "j"]
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best", pa.string()), ("best_n", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, group):
            words, n = [w.encode("latin-1") for w in table["word"].to_pylist()], table["n"].to_numpy()
            starts = np.append(_changes(table, group), len(words))
            of_group = lambda c: table[c].to_numpy()[starts[:-1]]
            pairs = near_in_groups(words, starts, table["longer"].to_numpy(), table["tile"].to_numpy(), of_group("a").astype(np.int64), of_group("part"),
                                   of_group("i") != of_group("j"))
            for u, v in pairs:
                if not len(u):
                    continue
                own, other = np.concatenate([u, v]), np.concatenate([v, u])
                named = np.unique(own)
                order_of = {r: i for i, r in enumerate(sorted(named.tolist(), key=lambda r: words[r]))}
                rank = np.array([order_of[r] for r in other.tolist()])
                by = np.lexsort((rank, -n[other], own))
                first = np.unique(own[by], return_index=True)[1]
                best = other[by][first]
                text = lambda ids: pa.array([words[r].decode("latin-1") for r in ids.tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([text(named), pa.array(np.diff(np.append(first, len(by)))), text(best), pa.array(n[best])], schema=schema)

    rows = rows.repartition(*group).sortWithinPartitions(*group)
    found = rows.mapInArrow(tidy(compare), "word string, n_near long, best string, best_n long")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("best"))).alias("b"))
    return found.select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.n")).alias("best_n"))


def _changes(table: pa.Table, key: list[str]) -> np.ndarray:
    """Where a new key begins in a sorted table."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for c in key:
        column = table[c].combine_chunks()
        codes = column.dictionary_encode().indices.to_numpy() if pa.types.is_string(column.type) else column.to_numpy()
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], key: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Tables of whole groups, about ``rows`` rows each, of batches sorted by ``key``; a group that is larger is one table."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < rows:
            continue
        table = pa.concat_tables(held).combine_chunks()
        last = int(_changes(table, key)[-1])
        if last:
            yield table.slice(0, last).combine_chunks()
        held = [table.slice(last)]
    if held and any(t.num_rows for t in held):
        yield pa.concat_tables(held).combine_chunks()


# --- forms and roots -------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """word and root (from word, follow ``forms`` (word, form) to the last) of the words that have a form.

    Each turn every word jumps to where its target points, which doubles the steps; counts at least double along a step, so
    a chain has at most 63 and six turns are enough.
    """
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        then = at.select(F.col("word").alias("root"), F.col("root").alias("then"))
        at = staged(at.join(then, "root", "left").select("word", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variant_groups(docs: DataFrame, least_length: int = 5, least_count: int = 3, every: int = 97) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary of all texts.

    A word's form is its near word of largest n (ties: the smallest in code-point order) if that n is at least twice its
    own, else null; root is where the forms lead (the word itself if it has none).  Null and empty texts have no words,
    repeated rows count again, a missing doc_id reads as empty, an empty table has no words, extra columns are ignored.
    """
    words = staged(vocabulary(docs, least_length, least_count, every), "vocabulary")
    near = words.join(near_words(words), "word", "left")
    known = F.col("best_n") >= 2 * F.col("n")
    near = staged(near.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(known, F.col("best")).alias("form"),
                              F.when(known, F.col("best_n")).alias("form_n")), "near")
    out = near.join(roots(near.where("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
