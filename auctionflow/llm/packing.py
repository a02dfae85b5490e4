"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most ``capacity`` tokens; pieces are packed into sequences.  The packing needs only
the histogram of piece lengths, which has at most ``capacity`` rows whatever the corpus size: per bin the largest length
left is placed and a bitset subset-sum over the lengths left finds the fullest feasible filling of the rest.  The same
filling is repeated while its lengths last, so the plan has a few thousand patterns at most.  Every piece then finds its
place from its rank among the pieces of its length, and ranks are prefix sums over hash buckets (no length is one task).
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auctionflow.llm.shared import bucket_count, staged, texts, tidy, with_offsets

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"

# --- tokens ---------------------------------------------------------------------


class _Chunks(dict):
    """Chunk of text -> its ids as little-endian bytes; forgets everything when full, to bound a worker's memory."""

    def __init__(self, encode: Callable[[str], list[int]], prefix: str, most: int):
        self.encode, self.prefix, self.most = encode, prefix, most

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self[chunk] = np.array(self.encode(self.prefix + chunk), dtype="<u4").tobytes()
        return ids


#: White space on both sides of a space (or its end): there a space is no token boundary.
_JOINED = re.compile(r"\s (?:\s|\Z)")


class Encoder:
    """Byte-level BPE ids of whole texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    The vocabulary's pattern never joins a space to what precedes it, so a text without runs of white space around a
    space splits at its spaces into chunks that encode alone; their ids are remembered.  Other texts are encoded whole,
    and so are texts that hold the string of an added token (``<|endoftext|>``), which is one id there.  Chunks in Latin letters go through a second implementation
    of the same merges if the vocabulary file allows it (ids in order of merging), which is several times as fast.
    """

    def __init__(self, path: str, most: int = 150_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = tuple(t.content for t in self.whole.get_added_tokens_decoder().values())
        fast = self._merges(path)
        slow = lambda s: self.whole.encode(s, add_special_tokens=False).ids
        encode = (lambda s: fast(s) if s.isascii() or max(s) < "ɐ" else slow(s)) if fast else slow
        self.plain = fast is not None
        self.first, self.rest = _Chunks(encode, "", most), _Chunks(encode, " ", most)

    @staticmethod
    def _merges(path: str) -> Callable[[str], list[int]] | None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, pre = spec["model"]["vocab"], spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or [
                vocab.get(m.replace(" ", "")) for m in merges] != list(range(256, 256 + len(merges))):
            return None
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level BPE writes as themselves
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if i < 256 + len(merges)}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        apart = not text.isascii() or text[-1] == " " or any(x in text for x in ("  ", " \n", "\t", "\r", "\x0b", "\x0c"))
        if not self.plain or (apart and _JOINED.search(text)) or any(x in text for x in self.added):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        head, *tail = text.split(" ")
        return (self.first[head] if head else b"") + b"".join(map(self.rest.__getitem__, tail))


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One encoder a worker process: its vocabulary is read once, not once a task."""
    return Encoder(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
                 keep_ids: bool = False) -> DataFrame:
    """Cut each document's ids (its tokens, then ``end_id``) into pieces of ``capacity``; the first may be shorter.

    Null and empty texts give the single id ``end_id``.  Returns doc_id, piece, start, length, ids_crc32 and ids (null
    unless ``keep_ids``).  Other columns of ``docs`` are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                            ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])
        for part in (batch.slice(start, 1000) for batch in batches for start in range(0, batch.num_rows, 1000)):
            rows: list[list] = [[] for _ in schema]
            for doc, text in zip(part.column(0).to_pylist(), texts(part.column(1))):
                ids = encoder.ids(text) + end
                n = len(ids) // 4
                lead = n % capacity or min(n, capacity)
                at, piece = 0, 0
                while at < n:
                    length = capacity if piece else lead
                    own = ids[4 * at:4 * (at + length)]
                    kept = np.frombuffer(own, dtype="<u4").astype(np.int32) if keep_ids else None
                    for column, value in zip(rows, (doc, piece, at, length, zlib.crc32(own), kept)):
                        column.append(value)
                    at, piece = at + length, piece + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(rows, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(cut), PIECES)


# --- the plan -------------------------------------------------------------------


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of ``lengths`` (descending, ``counts`` of each at hand) with the largest sum up to ``room``.

    Bitset subset-sum: bit s of ``reach`` is set if some choice of the lengths seen so far sums to s.  Copies of a length
    enter in powers of two.  Among equal sums, choices of longer lengths win.
    """
    reach, mask, trail = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        left, part = min(counts[length], room // length), 1
        while left > 0:
            take = min(part, left)
            trail.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, part = left - take, part * 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(trail):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def _slack_plan(histogram: dict[int, int], capacity: int, held: int) -> list[tuple[int, dict[int, int]]]:
    """Minimum bin slack over the lengths above ``held``; the shorter ones then fill what is left in those bins, the
    narrowest first, by the same step, and the rest of them are packed alike."""
    counts = {length: n for length, n in histogram.items() if n > 0}
    plan: list[tuple[int, dict[int, int]]] = []

    def pack_all(order: list[int]) -> None:
        while order:
            seed = order[0]
            counts[seed] -= 1
            chosen = fullest([x for x in order if x <= capacity - seed], counts, capacity - seed)
            counts[seed] += 1
            chosen[seed] = chosen.get(seed, 0) + 1
            take(min(counts[x] // n for x, n in chosen.items()), chosen, chosen)
            order = [x for x in order if counts[x]]

    def take(bins: int, used: dict[int, int], chosen: dict[int, int]) -> None:
        for x, n in used.items():
            counts[x] -= bins * n
        plan.append((bins, chosen))

    pack_all(sorted((x for x in counts if x > held), reverse=True))
    open_bins = sorted(((capacity - sum(x * n for x, n in chosen.items()), bins, chosen) for bins, chosen in plan), key=lambda b: b[0])
    plan.clear()
    for room, bins, chosen in open_bins:
        while bins:
            more = fullest([x for x in sorted(counts, reverse=True) if x <= min(held, room) and counts[x]], counts, room)
            now = min([bins, *(counts[x] // n for x, n in more.items())])
            take(now, more, chosen | more)
            bins -= now
    pack_all(sorted((x for x in counts if counts[x]), reverse=True))
    return plan


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """[(how many bins, {length: copies in each}), ...] over all pieces of ``histogram`` ({length: pieces}).

    Short pieces used up early are missed at the end, so the plan is made with several shares of the short lengths held
    back and the one with the fewest bins is taken.  Its cost depends on ``capacity`` alone.
    """
    assert all(0 < length <= capacity for length, n in histogram.items() if n)
    least = -(-sum(length * n for length, n in histogram.items()) // capacity)
    best: list[tuple[int, dict[int, int]]] | None = None
    for held in (0, *(capacity >> k for k in (7, 6, 5, 4, 3, 2, 1))):
        plan = _slack_plan(histogram, capacity, held)
        if best is None or sum(b for b, _ in plan) < sum(b for b, _ in best):
            best = plan
        if sum(b for b, _ in best) == least:
            break
    return best or []


def _places(plan: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """{length: rows of (first rank, copies a bin, first bin, offset)}, ascending by rank."""
    first, places, bin_id = {}, {}, 0
    for bins, chosen in plan:
        offset = 0
        for length, copies in sorted(chosen.items(), reverse=True):
            places.setdefault(length, []).append((first.get(length, 0), copies, bin_id, offset))
            first[length] = first.get(length, 0) + bins * copies
            offset += length * copies
        bin_id += bins
    return {length: np.array(rows, dtype=np.int64) for length, rows in places.items()}


def pack(pieces: DataFrame, capacity: int = 1024, rows_per_bucket: int = 50_000) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (columns as of ``token_pieces``): few sequences, gapless from offset 0.

    Repeated rows are pieces of their own.  Empty input gives an empty result.  ``pieces`` is read twice; stage it.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    places = _places(plan_bins(histogram, capacity))
    buckets = bucket_count(sum(histogram.values()), rows_per_bucket)
    keyed = pieces.withColumn("_h", F.xxhash64("doc_id", "piece", "start", "ids_crc32"))
    keyed = keyed.withColumn("_bucket", F.pmod("_h", F.lit(buckets)))
    ranked = with_offsets(keyed, ["length"], "_bucket", ["_h", "doc_id", "piece"], F.lit(1), "_rank").drop("_h", "_bucket")
    names = [c for c in ranked.columns if c != "_rank"]
    schema = ranked.select(*names, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            lengths = table["length"].to_numpy()
            ranks = table["_rank"].to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                at, rows = np.flatnonzero(lengths == length), places[int(length)]
                row = rows[np.searchsorted(rows[:, 0], ranks[at], side="right") - 1]
                since = ranks[at] - row[:, 0]
                sequence[at] = row[:, 2] + since // row[:, 1]
                offset[at] = row[:, 3] + since % row[:, 1] * length
            table = table.select(names)
            table = table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
            yield from table.to_batches()

    return ranked.select(*names, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2,
                   keep_ids: bool = False) -> DataFrame:
    """``token_pieces`` (staged: they are read twice and cost the most), then ``pack``."""
    pieces = token_pieces(docs, tokenizer, capacity, end_id, keep_ids)
    return pack(staged(pieces if keep_ids else pieces.drop("ids"), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each sequence in order; ``packed`` must have ids.  A group has ``capacity`` ids at most."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))
