"""Secret scans with an incremental blob ledger.

Every version of a text is content-addressed (``sha2``).  The ledger is a
Parquet table of (blob, rules, findings); a scan runs only for blob and
rule-version pairs that it lacks, once per distinct content, and the findings
are joined back to all rows that carry the blob.  Texts are shuffled once, to
meet the chosen bearer of their content; everything else moves hashes only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.llm.common import documents, no_text, scratch_root, slices, stage, strings, unused

#: Fixed patterns and least lengths of the base kinds, in the contract's order.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
BASE_KINDS = ("assign", "access", "hex")

#: Further rules of the scan: kind, pattern, and a cheap test that every match passes.
#: A kind with two patterns runs from a match of the first to the next one of the second.
MORE_RULES = (
    ("pem", (r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----", r"-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
     "PRIVATE KEY-----"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ"),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", "gh"),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", "xox"),
    ("urlauth", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]+:[^\s/:@]{3,}@", "://"),
)
KINDS = BASE_KINDS + tuple(k for k, _, _ in MORE_RULES)
RULES_VERSION = "1:" + hashlib.sha256(
    repr((ASSIGN, ACCESS, HEX, LEAST, MORE_RULES)).encode()).hexdigest()[:16]

LEDGER_SCHEMA = ("blob string, rules string, n_assign long, n_access long, n_hex long, "
                 "base_sha256 string, spans string")
_ARROW = pa.schema([("blob", pa.string()), ("rules", pa.string()), ("n_assign", pa.int64()),
                    ("n_access", pa.int64()), ("n_hex", pa.int64()),
                    ("base_sha256", pa.string()), ("spans", pa.string())])



def _matches(pattern: str) -> Callable[[str], list[tuple[int, int]]]:
    found = re.compile(pattern)
    return lambda text: [m.span() for m in found.finditer(text)]


def _between(first: str, last: str) -> Callable[[str], list[tuple[int, int]]]:
    """Leftmost spans from ``first`` to the next ``last``, none within another: all marks
    are found first and paired in one pass, so marks without a partner cost no search."""
    marks = [re.compile(f"(?=({p}))") for p in (first, last)]

    def spans(text: str) -> list[tuple[int, int]]:
        begins, ends = ([m.span(1) for m in mark.finditer(text)] for mark in marks)
        out, at, done = [], 0, 0
        for start, to in begins:
            if start < done:
                continue
            while at < len(ends) and ends[at][0] < to:
                at += 1
            if at == len(ends):
                break
            done = ends[at][1]
            out.append((start, done))
        return out

    return spans


# Explicit ASCII case folding: without re.A, "K" and "s" also match non-ASCII letters.
_ASSIGN = re.compile(ASSIGN, re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (LEAST["access"] - 4))
# A run of hex digits is maximal because the search is leftmost and greedy.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % LEAST["hex"])
_MORE = tuple((k, _between(*p) if isinstance(p, tuple) else _matches(p), hint) for k, p, hint in MORE_RULES)


def find_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of every span of a text, sorted; code
    points, end exclusive.  Kinds may overlap each other."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text)
           if len(m[1]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for rank, (_, search, hint) in enumerate(_MORE, len(BASE_KINDS)):
        if hint in text:
            out += [(a, rank, b) for a, b in search(text)]
    return sorted(out)


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


#: A linear-time test that every text with a finding passes.
_HINTS = (r"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{24}|PRIVATE KEY|eyJ|gh[pousr]_|"
          r"xox[abprs]-|://")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        text = strings(part.column("text"))
        hit = pc.match_substring_regex(text, _HINTS)
        found = []
        for t, h in zip(text, hit, strict=True):
            found.append(find_spans(t.as_py()) if h.as_py() else [])
        base = [[s for s in f if s[1] < len(BASE_KINDS)] for f in found]
        count = [[sum(s[1] == k for s in f) for f in base] for k in range(len(BASE_KINDS))]
        yield pa.RecordBatch.from_arrays(
            [part.column("blob"), pa.array([RULES_VERSION] * len(found), pa.string()),
             *(pa.array(c, pa.int64()) for c in count),
             pa.array([hashlib.sha256(_join(f).encode()).hexdigest() for f in base]),
             pa.array([_join(f) for f in found])], schema=_ARROW)


def _blob(docs: DataFrame) -> DataFrame:
    return documents(docs).select("doc_id", no_text(F.col("text")).alias("text")).withColumn(
        "blob", F.sha2("text", 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's findings, or an empty table where none was written yet."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    return spark.createDataFrame([], LEDGER_SCHEMA)


def scan_new(docs: DataFrame, ledger: str) -> DataFrame:
    """Scan the contents of ``docs`` that ``ledger`` lacks under the current
    rules, append the findings to it, and return (doc_id, blob) of all rows.

    One bearer per content is chosen from hashes alone (smallest doc_id, null
    ids last); only its text is scanned.  Rows that repeat a bearer's id with the
    same text give the same ledger row and are reduced to one.
    """
    spark = docs.sparkSession
    rows = _blob(docs)
    known = read_ledger(spark, ledger).where(F.col("rules") == RULES_VERSION).select("blob")
    paths = spark.read.parquet(stage(rows.select("doc_id", "blob"), "blobs"))
    bearers = (paths.groupBy("blob").agg(F.min("doc_id").alias("bearer"))
               .join(known, "blob", "left_anti"))
    scan = rows.join(bearers.hint("shuffle_hash"),
                     rows["doc_id"].eqNullSafe(bearers["bearer"])
                     & (rows["blob"] == bearers["blob"]), "left_semi")
    found = scan.select("blob", "text").mapInArrow(_scan, LEDGER_SCHEMA)
    found.dropDuplicates(["blob"]).write.mode("append").parquet(ledger)
    return paths


def scan(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """doc_id, blob, n_assign, n_access, n_hex, base_sha256, spans per row.

    A null text counts as empty; an empty text has no spans.  A null doc_id
    stays null.  Repeated rows give repeated results, an empty table an empty one.
    ``ledger`` names the folder of an existing or new ledger; without it a
    fresh one under ``spark.checkpoint.dir`` is used.
    """
    spark = docs.sparkSession
    if ledger is None:
        import uuid
        ledger = f"{scratch_root(spark)}/custlens-ledger-{uuid.uuid4().hex}"
    paths = scan_new(docs, ledger)
    # Scans that ran at once may both have entered a blob.
    found = read_ledger(spark, ledger).where(F.col("rules") == RULES_VERSION).drop("rules").dropDuplicates(["blob"])
    return paths.join(found, "blob").select("doc_id", "blob", "n_assign", "n_access", "n_hex",
                                            "base_sha256", "spans")


def _mark(texts: pd.Series, spans: pd.Series, mark: str) -> pd.Series:
    out = []
    for text, found in zip(texts, spans, strict=True):
        if text is not None and found:
            parts, end = [], 0
            for _, a, b in (x.split(":") for x in found.split(",")):
                if int(a) >= end:
                    parts += [text[end:int(a)], mark]
                end = max(end, int(b))
            text = "".join([*parts, text[end:]])
        out.append(text)
    return pd.Series(out, dtype=object)


def redact(docs: DataFrame, mark: str = "[SECRET]", ledger: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by one);
    ``n_chars``, where present, follows the text.  All rows and columns stay."""
    blob, spans, new = unused(docs.columns, "blob", "spans", "new_text")
    found = (scan(docs, ledger).where(F.col("spans") != "")
             .select(F.col("blob").alias(blob), F.col("spans").alias(spans)).dropDuplicates([blob]))
    rows = docs.withColumn(blob, F.sha2(no_text(F.col("text").cast("string")), 256)).join(found, blob, "left")
    changed = F.col(spans).isNotNull()
    text = F.col("text").cast("string")
    marked = F.pandas_udf(lambda t, s: _mark(t, s, mark), "string")
    # Rows without findings pass nulls to the function and keep their own text.
    rows = rows.withColumn(new, F.when(changed, marked(F.when(changed, text), F.col(spans))).otherwise(text))
    out = [F.col(new).alias("text") if c == "text"
           else F.when(changed, F.length(new)).otherwise(F.col(c))
           .cast(dict(docs.dtypes)[c]).alias(c) if c == "n_chars" else F.col(c)
           for c in docs.columns]
    return rows.select(out)
