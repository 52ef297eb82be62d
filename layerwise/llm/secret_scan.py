"""Secret scan with an incremental blob ledger.

Every text version is addressed by the SHA-256 of its UTF-8 bytes.  The ledger is a Parquet table
(rule_version, blob, findings) on shared storage: a run scans only blobs that the ledger does not
hold for the current rule version, one text per blob, appends them, and joins the findings back to
every row that has the blob.  Copies and texts seen in earlier runs are never scanned again; a new
rule version scans everything once more beside the old entries.

Rules are leftmost non-overlapping searches; offsets are code points, ends exclusive.  Base kinds
assign, access, hex; the further kinds only add spans.

Defined results: a null text is the empty blob (no findings); repeated rows each get their row;
the ledger may be empty or missing.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwise.llm.common import few_files, freeing_shuffles, id_text, prepare
from layerwise.llm.textnp import chunks, class_table, text_buffer, words
from layerwise.session import path_exists, scratch_path

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_BYTES = ~class_table([(0x30, 0x39), (0x61, 0x66)])

# (kind, a literal every match holds, pattern) of the added kinds, in output order after the base kinds
ADDED = [
    ("pem", "-----BEGIN ", re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----")),
    ("jwt", "eyJ", re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    ("forge", "gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    ("chat", "xox", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    ("login_url", "://", re.compile(r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@")),
]
KINDS = ["assign", "access", "hex"] + [k for k, _, _ in ADDED]
RULE_VERSION = "r1"
FINDINGS = "array<struct<kind:string,start:int,end:int>>"


def find_in_text(text: str, hex_runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all findings; hex_runs are the maximal hex runs of 32+ characters."""
    out = [(a, 2, b) for a, b in hex_runs]
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    for n, (_, literal, pattern) in enumerate(ADDED, 3):
        if literal in text:
            out += [(m.start(), n, m.end()) for m in pattern.finditer(text)]
    return sorted(out)


def _scan_runner():
    def run(batches):
        for batch in batches:
            col = batch.column(1)
            buf, off = text_buffer(col)
            rows: list[list] = []
            for a, b in chunks(off):
                part, po = buf[off[a]:off[b]], off[a:b + 1] - off[a]
                st, en, wo = words(part, po, HEX_BYTES)
                long_runs = (en - st) >= 32
                for d in range(b - a):
                    raw = part[po[d]:po[d + 1]].tobytes()
                    runs = []
                    lo, hi = int(wo[d]), int(wo[d + 1])
                    for r in (long_runs[lo:hi].nonzero()[0] + lo).tolist():
                        s = len(raw[:int(st[r] - po[d])].decode())
                        runs.append((s, s + int(en[r] - st[r])))
                    rows.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find_in_text(raw.decode(), runs)])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["blob", "findings"])
    return run


def read_ledger(spark: SparkSession, path: str, rule_version: str) -> DataFrame:
    """Entries of one rule version; an empty frame where nothing was written yet."""
    schema = f"blob string, findings {FINDINGS}"
    if not path_exists(spark, f"{path}/rule_version={rule_version}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/rule_version={rule_version}")


def scan(docs: DataFrame, ledger: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """Update the ledger with the unseen blobs of ``docs``; return (doc_id, blob, findings) for every row."""
    spark = docs.sparkSession
    prepare(spark)
    texts = id_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("blob", F.sha2("text", 256))
    paths = texts.select("doc_id", "blob")
    seen = read_ledger(spark, ledger, rule_version).select("blob")
    fresh = paths.groupBy("blob").agg(F.min(F.coalesce("doc_id", F.lit(-1))).alias("one")).join(seen, "blob", "left_anti")
    fresh = fresh.select(F.col("one").alias("f_one"), F.col("blob").alias("f_blob"))
    todo = texts.join(fresh, (F.coalesce("doc_id", F.lit(-1)) == F.col("f_one")) & (F.col("blob") == F.col("f_blob")), "left_semi")
    entries = todo.select("blob", "text").mapInArrow(_scan_runner(), f"blob string, findings {FINDINGS}")
    with freeing_shuffles(spark):
        few_files(entries).write.mode("append").parquet(f"{ledger}/rule_version={rule_version}")
    known = read_ledger(spark, ledger, rule_version).dropDuplicates(["blob"])
    return paths.join(known, "blob", "left")


def scan_report(docs: DataFrame, ledger: str | None = None, rule_version: str = RULE_VERSION) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    found = scan(docs, ledger or scratch_path(docs.sparkSession, "secret-ledger"), rule_version)
    order = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        ranked = F.array_sort(F.transform(spans, lambda x: F.struct(
            x["start"].alias("start"), F.array_position(order, x["kind"]).alias("rank"), x["end"].alias("end"), x["kind"].alias("kind"))))
        return F.array_join(F.transform(ranked, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    spans = F.coalesce("findings", F.array().cast(FINDINGS))
    base = F.filter(spans, lambda x: x["kind"].isin(*KINDS[:3]))

    def number(kind):
        return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    counts = [number(k).alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(spans).alias("spans"))
