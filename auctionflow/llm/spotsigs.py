"""Document fingerprints by SpotSigs.

Every common word (anchor) of a text, followed by the next content words in a chain, is a spot signature.  The set of a
text's signatures is its fingerprint; likeness is the Jaccard similarity of two sets.  Frames, lists and other text
without common words give few signatures, running prose gives many.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auctionflow.llm.shared import mixed, staged, texts, word_hashes

#: Common words of English, German, French and Spanish; a parameter of every function here.
COMMON = tuple("""the of and to in is that for it was with as be on by at this from or an are a
der die das und ist nicht ein eine von zu den mit sich auf für im dem
le la les de des et est que un une dans pour pas au du qui en sur
el los las y es por con una del se lo su para al más""".split())

#: ASCII upper to lower case, ASCII punctuation to spaces; other bytes stay.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if 33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 else c for c in range(256))


def signatures(text: str, chain: int = 2, distance: int = 1, common: np.ndarray | None = None) -> np.ndarray:
    """The text's spot signatures as sorted distinct 64-bit hashes.

    A signature is an anchor and the next ``chain`` content words after it, each ``distance`` content words on.  Shorter
    chains at the end of a text count.  A text of words without any signature is signed by its words; one without words
    has none.
    """
    common = common_hashes() if common is None else common
    words = text.encode().translate(_PLAIN).split() or text.encode().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words, len(words))
    slot = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    anchor = common[slot] == hashes
    spots, content = np.flatnonzero(anchor), np.flatnonzero(~anchor)
    if not len(spots) or not len(content):
        return np.unique(mixed(hashes, 3))
    # content words after a spot: all of those before it are passed
    first = spots - np.arange(len(spots)) + distance - 1
    chained = mixed(hashes[spots], 1)
    ends = np.append(hashes[content], np.uint64(0))
    with np.errstate(over="ignore"):
        for k in range(chain):
            chained = mixed(chained + ends[np.minimum(first + k * distance, len(content))], 2)
    chained = chained[first < len(content)]
    return np.unique(chained) if len(chained) else np.unique(mixed(hashes, 3))


def common_hashes(words: tuple[str, ...] = COMMON) -> np.ndarray:
    return np.unique(word_hashes([w.encode() for w in words], len(words)))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity; 1 for two empty sets.  Below ``least`` by the sets' lengths alone, 0 without comparing."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large or not small:
        return 0.0
    common = len(a) + len(b) - len(np.union1d(a, b))
    return common / (len(a) + len(b) - common)


def fingerprint(signed: np.ndarray) -> str:
    """The set as a string: its members in ascending order, 16 hex digits each; ``members`` reads them back."""
    return signed.astype(">u8").tobytes().hex()


def members(printed: str) -> np.ndarray:
    """The signatures of a ``fingerprint``, so two fingerprints suffice for ``likeness``."""
    return np.frombuffer(bytes.fromhex(printed), ">u8").astype(np.uint64)


def digest(signed: np.ndarray) -> str:
    """A short name of the set, to group equal ones: its length and a 128-bit digest of its sorted members."""
    return f"{len(signed)}:{xxhash.xxh3_128_hexdigest(signed.tobytes())}"


def length_partition(length: Column, least: float) -> Column:
    """Partitions of set lengths such that sets of similarity ``least`` are in the same or in adjacent ones."""
    if least >= 1:
        return length.cast("long")
    return F.floor(F.log(F.greatest(length, F.lit(1))) / -math.log(least) + 1e-9) if least > 0 else F.lit(0).cast("long")


# --- all similar pairs -----------------------------------------------------------


def similar_pairs(docs: DataFrame, least: float = 0.8, chain: int = 2, distance: int = 1) -> DataFrame:
    """Pairs (a, b, likeness) of different signature sets with likeness >= ``least``, by their smallest doc_ids.

    Documents with equal sets are one class, represented by its smallest doc_id (``signed`` gives the membership).  Sets
    are partitioned by length and meet those of their own and the next partition; there, candidates share one of the
    rarest signatures that any similar pair must share (prefix filtering), and each is compared once, pruned by length.
    """
    sets = staged(signed(docs, chain, distance).where("doc_id is not null and n_signatures > 0"), "signed")
    classes = staged(sets.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "classes")
    heads = staged(sets.join(classes, ["digest", "doc_id"], "left_semi").dropDuplicates(["doc_id"]), "heads")
    each = heads.select("doc_id", "n_signatures", F.explode("signatures").alias("s"))
    rarity = each.groupBy("s").agg(F.count("*").alias("n")).where("n > 1")
    common = each.join(rarity, "s")
    # a pair shares least * the larger set's length at least, so one of the first n - ceil(least * n) + 1 by rarity;
    # signatures that no other set has can't be the shared one but do count as the rarest
    spare = F.floor(F.col("n_signatures") * F.lit(1 - least) + F.lit(1e-9)) + 1
    alone = common.groupBy("doc_id", "n_signatures").agg(F.sort_array(F.collect_list(F.struct("n", "s"))).alias("by_rarity"))
    left = (spare - (F.col("n_signatures") - F.size("by_rarity"))).cast("int")
    prefix = alone.where(left > 0).select("doc_id", "n_signatures", F.explode(F.slice("by_rarity", F.lit(1), left)).alias("p"))
    prefix = prefix.select("doc_id", "n_signatures", "p.s")
    prefix = prefix.withColumn("part", length_partition(F.col("n_signatures"), least))
    other = prefix.select(F.col("doc_id").alias("b"), F.col("n_signatures").alias("nb"), "s", "part")
    mine = prefix.select(F.col("doc_id").alias("a"), F.col("n_signatures").alias("na"), "s", F.col("part").alias("own"),
                         F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    near = (F.least("na", "nb") >= F.greatest("na", "nb") * least - 1e-9) & ((F.col("own") < F.col("part")) | (F.col("a") < F.col("b")))
    pairs = mine.join(other, ["s", "part"]).where(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    set_a = heads.select(F.col("doc_id").alias("a"), F.col("signatures").alias("sa"))
    set_b = heads.select(F.col("doc_id").alias("b"), F.col("signatures").alias("sb"))
    compared = pairs.join(set_a, "a").join(set_b, "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    value = shared / (F.size("sa") + F.size("sb") - shared)
    return compared.select("a", "b", value.alias("likeness")).where(F.col("likeness") >= least)


def signed(docs: DataFrame, chain: int = 2, distance: int = 1) -> DataFrame:
    """doc_id, n_signatures, digest and signatures of every row; null text: empty, without signatures."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = common_hashes()
        for batch in batches:
            sets = [signatures(t, chain, distance, common) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.string()),
                pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "n_signatures", "digest", "signatures"])

    return rows.mapInArrow(sign, "doc_id long, n_signatures long, digest string, signatures array<long>")


# --- each document beside an edited copy and its successor ---------------------------


#: Characters of texts and fingerprints that a task gathers before it hands out a batch.
FLUSH_CHARS = 8_000_000


def _lowest(keys: DataFrame, cuts: np.ndarray) -> list[int]:
    """The smallest key of the table in each range between ``cuts``, in order; ranges without keys have none."""

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.sort(batch.column(0).to_numpy())
            part, at = np.unique(np.searchsorted(cuts, own, side="right"), return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(own[at])], names=["part", "key"])

    found = keys.mapInArrow(lowest, "part long, key long").groupBy("part").agg(F.min("key").alias("key"))
    return sorted(r.key for r in found.collect())  # one row a range


def _ranges(named: DataFrame, others: DataFrame, parts: int) -> tuple[np.ndarray, int]:
    """The first keys of about ``parts`` ranges of like size, in order, and how many of them are of rows with an id.

    Both have a key.  Ranges of ``others``, rows without id, follow those of ``named``; their keys are hashes, cut evenly.
    Every first key is one of the table: quantiles of ids are, unless beyond the 53 bits that they are kept in.
    """
    shares = [i / parts for i in range(1, parts)] or [0.5]
    low, high, n, cuts = named.agg(F.min("key"), F.max("key"), F.count("*"), F.percentile_approx("key", shares, 10_000)).first()
    n_others = others.count()
    share = lambda some: max(1, round(parts * some / (n + n_others)))
    firsts = []
    if n:
        firsts = sorted({low, *(cuts[i * parts // share(n) - 1] for i in range(1, share(n)))})
        if max(-low, high) >= 2 ** 53:
            firsts = _lowest(named, np.array(firsts[1:], dtype=np.int64))
    with_id = len(firsts)
    if n_others:
        want = share(n_others)
        firsts += _lowest(others, np.array([2 ** 64 * i // want - 2 ** 63 for i in range(1, want)], dtype=np.int64))
    return np.array(firsts, dtype=np.int64), with_id


def beside_next(docs: DataFrame, chain: int = 2, distance: int = 1, parts: int | None = None) -> DataFrame:
    """Every document with its edited text and its successor: doc_id, n_chars, edited (text), fingerprint,
    edited_fingerprint, near_edited and near_next.

    The order is by doc_id, then text; rows without id come last, by the hash of their text, so that they too are dealt
    into many ranges (those of one text stay together).  The edited text replaces the last floor(n_chars / 2) code points
    by as many first ones (or all) of the next document; after the last comes the first.  Documents are dealt into ranges
    that begin at keys of the table, and the rows of a first key go to the range before as well, so each range knows every
    successor, and texts are shuffled once.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc, F.xxhash64(text)).alias("key"), doc.isNull().alias("no_id"), text.alias("text"))
    parts = parts or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named, others = docs.select(doc.alias("key")).where("key is not null"), docs.where(doc.isNull()).select(F.xxhash64(text).alias("key"))
    firsts, with_id = _ranges(named, others, parts)
    n = max(1, len(firsts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, no_id = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            own = np.where(no_id, with_id + np.searchsorted(firsts[with_id:], keys, side="right"),
                           np.searchsorted(firsts[:with_id], keys, side="right")) - 1
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.zeros(len(own), np.int32)), *batch.columns], names=names)
            at_first = keys == firsts[own]
            if at_first.any():
                extra, to = batch.filter(pa.array(at_first)), own[at_first]
                yield pa.RecordBatch.from_arrays([pa.array((to - 1) % n), pa.array(np.ones(len(to), np.int32)), *extra.columns], names=names)

    names = ["part", "guest", "key", "no_id", "text"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = common_hashes()
        part, before, set_before = None, None, None
        out: list[list] = [[] for _ in schema]
        held = 0

        def emit(own, signed_own, text_next, signed_next):
            doc, no_id, text = own
            half = len(text) // 2
            edited = text[:len(text) - half] + text_next[:half]
            signed_edited = signatures(edited, chain, distance, common)
            for column, value in zip(out, (None if no_id else doc, len(text), edited, fingerprint(signed_own), fingerprint(signed_edited),
                                           likeness(signed_own, signed_edited), likeness(signed_own, signed_next))):
                column.append(value)
            return len(edited) + 16 * (len(signed_own) + len(signed_edited))

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for to, guest, doc, no_id, text in zip(*columns, texts(batch.column(4))):
                if to != part:
                    part, before = to, None
                if guest and before is None:
                    continue  # a second row at the cut: the first has already served
                signed_now = signatures(text, chain, distance, common)
                if before is not None:
                    held += emit(before, set_before, text, signed_now)
                    if held >= FLUSH_CHARS:
                        yield flush()
                        out, held = [[] for _ in schema], 0
                before, set_before = (None, None) if guest else ((doc, no_id, text), signed_now)
            yield flush()
            out, held = [[] for _ in schema], 0

    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    dealt = rows.mapInArrow(deal, "part long, guest int, key long, no_id boolean, text string")
    ordered = dealt.repartition(n, "part").sortWithinPartitions("part", "guest", "key", "text")
    return ordered.mapInArrow(compare, "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
