"""Secret scans with an incremental blob ledger.

Texts are content-addressed (SHA-256).  Each distinct blob is scanned once for each rule version, and the ledger keeps
the findings of every pair of blob and rule version that was scanned.  A later scan works on the pairs that the ledger
lacks only.  Findings are joined back to all paths of a blob, in whatever version of the corpus they stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auctionflow.llm.bitmap import id_bitmap, in_bitmap
from auctionflow.llm.shared import staged, texts, tidy


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched from left to right without overlaps; matches whose group ``group`` is shorter than
    ``least`` are dropped (but what they cover stays covered).  Texts without any of ``needs`` (lower case) are skipped."""

    kind: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    needs: tuple[str, ...] = ()

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed by the query's contract: the three base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2,
         ("password", "passwd", "secret", "token", "apikey", "api_key")),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 18, 0, ("akia",)),
    Rule("hex", 1, r"[0-9a-f]{16,}", 16),  # runs are maximal, so the shorter ones can be left out at once
)
#: Further kinds of this operator.
MORE = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----)?", 0, 0, ("private key",)),
    Rule("bearer", 1, r"(?i:bearer) +([A-Za-z0-9_.~+/-]+=*)", 20, 1, ("bearer",)),
    # begins where no token character precedes, so a run of characters is read once however often it says eyJ
    Rule("signed_token", 2, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++", 30, 0, ("eyj",)),
)
RULES = BASE + MORE

FINDING = "array<struct<kind:string,start:long,end:long>>"


def scan_text(text: str, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every finding, in code points, end exclusive; by start, then by the order of the rules."""
    found, low = [], None
    for order, rule in enumerate(rules):
        if rule.needs:
            low = text.lower() if low is None else low
            if not any(x in low for x in rule.needs):
                continue
        for m in re.compile(rule.pattern, re.ASCII).finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), order, rule.kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def addressed(versions: DataFrame) -> DataFrame:
    """Add blob (the text's SHA-256, null text: the empty one) to the rows."""
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """blob, rule and findings (may be empty) of each row of ``blobs`` (blob, text, rules: the rule ids to scan for)."""
    by_id = {r.id: r for r in rules}
    schema = pa.schema([("blob", pa.string()), ("rule", pa.string()),
                        ("findings", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for blob, text, ids in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2).to_pylist()):
                for rule in ids:
                    spans = scan_text(text, (by_id[rule],))
                    for column, value in zip(out, (blob, rule, [{"kind": k, "start": s, "end": e} for k, s, e in spans])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return blobs.select("blob", "text", "rules").mapInArrow(scan, f"blob string, rule string, findings {FINDING}")


def _heads(versions: DataFrame) -> DataFrame:
    """One row (blob, text) for each distinct text of ``versions`` (path, text): the first by hash of its path.

    Rows that repeat path and text, as null paths often do, are equal, so any of them will do: each task passes one of them
    on, which keeps a text that stands on a third of all rows from meeting in one place, and of those one stays.
    """
    rows = addressed(versions.select("path", "text")).withColumn("h", F.xxhash64(F.coalesce(F.col("path").cast("string"), F.lit(""))))
    first = rows.groupBy("blob").agg(F.min("h").alias("h"))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()
        for batch in batches:
            new = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    mine = rows.select("blob", "h", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(tidy(once), "blob string, h long, text string")
    mine = mine.join(first, ["blob", "h"], "left_semi")
    mine = mine.withColumn("i", F.row_number().over(Window.partitionBy("blob", "h").orderBy(F.lit(0))))
    return mine.where("i = 1").select("blob", "text")


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger entries (blob, rule, findings) for what ``versions`` (path, text) hold and ``ledger`` lacks.

    ``ledger`` has an entry for each scanned pair, findings or not.  Append the result to it before the next scan.  Each pair
    is scanned once and gets one entry, however many rows share path and text.
    """
    ids = [r.id for r in rules]
    blobs = _heads(versions)
    if ledger is None:
        unseen = blobs.withColumn("rules", F.array(*[F.lit(i) for i in ids]))
    else:
        known = ledger.where(F.col("rule").isin(ids)).groupBy("blob").agg(F.collect_set("rule").alias("known"))  # as many as rules
        unseen = blobs.join(known, "blob", "left").withColumn(
            "rules", F.array_except(F.array(*[F.lit(i) for i in ids]), F.coalesce("known", F.array().cast("array<string>"))))
        unseen = unseen.where(F.size("rules") > 0)
    return scan_blobs(unseen, rules)


def findings_by_blob(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob and spans (kind, start, end by start, then in the order of ``rules``) of the blobs that have any."""
    rank = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("f.kind"))
    some = ledger.where(F.col("rule").isin([r.id for r in rules]) & (F.size("findings") > 0))
    each = some.select("blob", F.explode("findings").alias("f")).distinct()
    spans = each.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("f.start", rank.alias("rank"), "f.kind", "f.end"))).alias("s"))
    return spans.select("blob", F.transform("s", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("spans"))


def scan_documents(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """(doc_id, blob and spans of every row, the new ledger entries).  Null texts are empty; repeated rows stay.

    Extra columns of ``docs`` are ignored.  A row without doc_id is a path of its own kind: the null path.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("path"), F.col("text").cast("string").alias("text"))
    new = staged(update_ledger(rows, ledger, rules), "ledger")
    whole = new if ledger is None else ledger.select("blob", "rule", "findings").unionByName(new)
    found = findings_by_blob(whole, rules)
    paths = addressed(rows).select(F.col("path").alias("doc_id"), "blob")
    none = F.array().cast(FINDING)
    return paths.join(found, "blob", "left").select("doc_id", "blob", F.coalesce("spans", none).alias("spans")), new


def joined(spans: Column) -> Column:
    """kind:start:end of ``spans``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every finding in text replaced by ``mark`` and n_chars, where it is a column, brought up to date.

    Overlapping findings are replaced as one.  Rows without findings pass as they are; nothing is dropped.  Findings
    meet only the rows that a bitmap of the blobs with findings lets through.
    """
    versions = docs.select(F.col("doc_id").cast("long").alias("path"), F.col("text").cast("string").alias("text"))
    spans = staged(findings_by_blob(staged(update_ledger(versions, None, rules), "ledger"), rules), "findings")
    blob = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)
    rows = docs.select(F.struct("*").alias("_row"), blob.alias("blob")).withColumn("_h", F.xxhash64("blob"))
    rows = in_bitmap(rows, "_h", id_bitmap(spans.select(F.xxhash64("blob").alias("h"))), ["_row", "blob"])
    hit = rows.where("found").join(spans, "blob", "left").select("_row", "spans")
    columns = docs.columns
    at = columns.index("text")
    size = columns.index("n_chars") if "n_chars" in columns else None

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found = batch.column(0).flatten(), batch.column(1).to_pylist()
            new = []
            for text, own in zip(row[at].to_pylist(), found):
                if own:
                    out, done = [], 0
                    for s, e in sorted((x["start"], x["end"]) for x in own):
                        if s >= done:
                            out += (text[done:s], mark)
                        done = max(done, e)
                    text = "".join(out) + text[done:]
                new.append(text)
            if size is not None:
                old = row[size].to_pylist()
                row[size] = pa.array([len(t) if own else n for t, own, n in zip(new, found, old)], row[size].type)
            row[at] = pa.array(new, row[at].type)
            yield pa.RecordBatch.from_arrays(row, names=columns)

    return rows.where("not found").select("_row.*").unionByName(hit.mapInArrow(replace, docs.schema))
