"""Source divergence audit by one-hot level products.

For each language and source the counts of the language's kept terms are one column of
a table, terms by sources.  Written with an indicator column for each (source, count
level), the table times its own transpose holds, for any two sources, how many terms
have count a in the one and count b in the other: their joint table.  A price that
depends on the two counts only, here the distance of two smoothed shares, is then
summed over the cells of the joint table instead of over terms.

The products are taken in blocks: terms are dealt by hash into chunks, a language's
sources into bands, and a task multiplies the indicator columns of two bands for one
chunk, some hundred terms of like frequency and a few sources at a time, so that a
product stays small and exact (single floats count to 2 ** 24).  Tables of several
chunks add up, and so do their prices; only these leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.llm.common import importable, slices, stage, strings, word_arrays

#: What stands between terms.
TERM_GAP = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: A language keeps terms found in so many of its documents.
LEAST_DOCS = 30
#: Smoothing, scale of the shares and rows of the term part.
SMOOTH, SCALE, TOP = 5, 1_000_000_000, 50

#: Terms of a chunk and sources of a band (what a task holds), terms and sources of one product.
CHUNK, BAND, TERMS, SOURCES = 4096, 256, 256, 8
#: Groups and characters of their names up to which the group table is broadcast.
SMALL_ROWS, SMALL_CHARS = 100_000, 8_000_000

_COUNTED = "lang string, term string, docs long, counts array<struct<source:string,n:long>>"
_PRICED = "lang string, source string, other string, value long"


# -- counts -----------------------------------------------------------------------

def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice of texts a row for each language and term: its documents, and its
    occurrences by source."""
    for part in slices(batches):
        lang, source = (strings(part.column(c)).dictionary_encode() for c in ("lang", "source"))
        words, code, off = word_arrays(part.column("text"), lower=True, gap=TERM_GAP)
        if not len(words):
            continue
        width, n_sources = len(words), len(source.dictionary)
        # Occurrences by document and term, then by language, term and source.
        cell, n = np.unique(np.repeat(np.arange(part.num_rows), np.diff(off)) * width + code, return_counts=True)
        doc, term = cell // width, cell % width
        lang_of, source_of = (np.asarray(x.indices).astype(np.int64) for x in (lang, source))
        key = (lang_of[doc] * width + term) * n_sources + source_of[doc]
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        total, docs = np.add.reduceat(n, at), np.diff(np.append(at, len(key)))
        key = key[at]
        top = key // n_sources
        first = np.flatnonzero(np.diff(top, prepend=-1))
        counts = pa.ListArray.from_arrays(
            pa.array(np.append(first, len(key)).astype(np.int32)),
            pa.StructArray.from_arrays([source.dictionary.take(pa.array(key % n_sources)), pa.array(total)],
                                       ["source", "n"]))
        yield pa.RecordBatch.from_arrays(
            [lang.dictionary.take(pa.array(top[first] // width)), words.take(pa.array(top[first] % width)),
             pa.array(np.add.reduceat(docs, first)), counts], ["lang", "term", "docs", "counts"])


def kept_counts(rows: DataFrame, least_docs: int) -> DataFrame:
    """lang, source, term, n for kept terms, with the language's count of the term
    (``total``) and a mark on one row of each term (``lead``).  Counts of a slice are
    summed before the only exchange, which is by language and term."""
    term = Window.partitionBy("lang", "term")
    return (rows.mapInArrow(count_terms, _COUNTED)
            .repartition("lang", "term")
            .select("lang", "term", "docs", F.posexplode("counts").alias("k", "c"))
            .groupBy("lang", "term", F.col("c.source").alias("source"))
            .agg(F.sum("c.n").alias("n"), F.sum(F.when(F.col("k") == 0, F.col("docs"))).alias("docs"))
            .withColumn("df", F.sum("docs").over(term))
            .where(F.col("df") >= least_docs)
            .withColumn("total", F.sum("n").over(term))
            .withColumn("lead", (F.row_number().over(term.orderBy("source")) == 1).cast("long"))
            .select("lang", "source", "term", "n", "total", "lead"))


def group_table(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """A row for each occurring (lang, source): its count of kept terms (``size``), the
    language's (``lang_size``), the number of kept terms and the group's place."""
    lang = Window.partitionBy("lang")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.sum("lead").alias("led"))
    return (rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left")
            .select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"),
                    F.coalesce(F.sum("size").over(lang), F.lit(0)).alias("lang_size"),
                    F.coalesce(F.sum("led").over(lang), F.lit(0)).alias("terms"),
                    (F.row_number().over(lang.orderBy("source")) - 1).alias("place")))


def share(count: str, size: str) -> F.Column:
    """1 + floor(SCALE * (count + SMOOTH) / (size + SMOOTH * terms)) in whole numbers."""
    return F.expr(f"1 + (cast({SCALE} as decimal(20, 0)) * ({count} + {SMOOTH})) div ({size} + {SMOOTH} * terms)")


# -- products ---------------------------------------------------------------------

def _levels(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indicator columns of a block of counts (terms by sources): the matrix, each
    column's source and its count."""
    t, g = counts.shape
    span = int(counts.max(initial=0)) + 1
    key, column = np.unique(counts + np.arange(g) * span, return_inverse=True)
    hot = np.zeros((t, len(key)), np.float32)
    hot[np.arange(t)[:, None], column.reshape(t, g)] = 1
    return hot, key // span, key % span


def _prices(source: np.ndarray, level: np.ndarray, sizes: list[int], terms: int) -> np.ndarray:
    return np.array([1 + SCALE * (int(c) + SMOOTH) // (sizes[s] + SMOOTH * terms)
                     for s, c in zip(source.tolist(), level.tolist(), strict=True)], np.int64)


def distances(a: np.ndarray, b: np.ndarray | None, sizes_a: list[int], sizes_b: list[int],
              terms: int, n_terms: int = TERMS, n_sources: int = SOURCES) -> np.ndarray:
    """Sum of the distance of shares over the terms (rows) of ``a`` and ``b``, for each
    source of ``a`` and of ``b`` (None: ``a`` itself, pairs above the diagonal only)."""
    same = b is None
    b, sizes_b = (a, sizes_a) if same else (b, sizes_b)
    out = np.zeros((a.shape[1], b.shape[1]), np.int64)
    # Terms of like frequency have few levels.
    order = np.argsort(a.sum(1) if same else a.sum(1) + b.sum(1), kind="stable")
    for x in range(0, len(order), n_terms):
        rows = order[x:x + n_terms]
        held: dict = {}

        def columns(which, m, sizes, y, rows=rows, held=held):
            if (which, y) not in held:
                hot, source, level = _levels(m[rows, y:y + n_sources])
                held[which, y] = hot, source, _prices(source, level, sizes[y:y + n_sources], terms)
            return held[which, y]

        for y in range(0, a.shape[1], n_sources):
            left, of_left, price_left = columns("a", a, sizes_a, y)
            for z in range(y if same else 0, b.shape[1], n_sources):
                right, of_right, price_right = columns("a" if same else "b", b, sizes_b, z)
                joint = (left.T @ right).astype(np.int64)
                joint *= np.abs(price_left[:, None] - price_right[None, :])
                block = np.add.reduceat(joint, np.flatnonzero(np.diff(of_left, prepend=-1)), axis=0)
                out[y:y + n_sources, z:z + n_sources] += np.add.reduceat(
                    block, np.flatnonzero(np.diff(of_right, prepend=-1)), axis=1)
    return out


def price_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of two bands of sources and one chunk of terms to priced pairs of sources."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = {n: batch.column(n)[k].as_py() for n in ("lang", "n_terms", "terms", "band", "other_band")}
            same = row["band"] == row["other_band"]
            names, sizes, counts = [], [], []
            for side in ("", "other_")[:1 if same else 2]:
                band = batch.column(f"{side}groups")[k].values
                names.append(band.field("source").to_pylist())
                sizes.append(band.field("size").to_pylist())
                table = np.zeros((row["n_terms"], len(names[-1])), np.int64)
                cells = batch.column(f"{side}cells")[k].values
                if cells is not None and len(cells):
                    t, s, n = (np.asarray(cells.field(f)) for f in ("t", "s", "n"))
                    table[t, s] = n
                counts.append(table)
            got = distances(counts[0], None if same else counts[1], sizes[0], sizes[-1], max(1, row["terms"]))
            at = np.triu_indices(len(names[0]), 1) if same else tuple(x.ravel() for x in np.indices(got.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["lang"]] * len(at[0]), pa.string()),
                 pa.array(names[0], pa.string()).take(pa.array(at[0])),
                 pa.array(names[-1], pa.string()).take(pa.array(at[1])),
                 pa.array(got[at])], ["lang", "source", "other", "value"])


# -- the audit --------------------------------------------------------------------

def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, chunk: int = CHUNK, band: int = BAND) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank.

    Null texts, languages and sources are empty; each row counts as a document, also a
    repeated one.  A group without kept terms has zero counts, and a language without
    any the distance 0 between all of its sources.  Ties of value go by item in byte
    order.  Without documents there are no rows; other columns play no part.
    """
    spark = docs.sparkSession
    importable(spark)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = spark.read.parquet(stage(kept_counts(rows, least_docs), "audit-counts"))
    groups = spark.read.parquet(stage(group_table(rows, kept), "audit-groups"))
    n, chars = groups.agg(F.count("*"), F.sum(F.length("lang") + F.length("source"))).first()
    small = n <= SMALL_ROWS and (chars or 0) <= SMALL_CHARS
    priced = kept.join(F.broadcast(groups) if small else groups, ["lang", "source"])

    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (priced.select("lang", "source", F.col("term").alias("item"),
                           (share("n", "size") - share("total", "lang_size")).alias("value"))
             .where("value > 0").withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= TOP))

    # Terms of a chunk are numbered by name; a tile has the counts of one chunk and band.
    in_chunk = Window.partitionBy("lang", "chunk")
    cells = (priced.withColumn("chunk", F.pmod(F.xxhash64("term"), F.ceil(F.col("terms") / chunk)))
             .withColumn("t", (F.dense_rank().over(in_chunk.orderBy("term")) - 1).cast("int"))
             .withColumn("n_terms", F.max("t").over(in_chunk) + 1)
             .withColumn("band", F.floor(F.col("place") / band)))
    tiles = spark.read.parquet(stage(
        cells.groupBy("lang", "chunk", "band").agg(
            F.max("n_terms").alias("n_terms"),
            F.collect_list(F.struct("t", (F.col("place") % band).cast("int").alias("s"), "n")).alias("cells")),
        "audit-tiles"))
    bands = groups.groupBy("lang", F.floor(F.col("place") / band).alias("band")).agg(
        F.max("terms").alias("terms"),
        F.sort_array(F.collect_list(F.struct("place", "source", "size"))).alias("groups"))
    # A chunk without terms stands for each language, so that all of its pairs come out.
    chunks = tiles.groupBy("lang", "chunk").agg(F.max("n_terms").alias("n_terms")).unionByName(
        bands.where("band = 0").select("lang", F.lit(-1).cast("long").alias("chunk"), F.lit(0).alias("n_terms")))
    other = bands.select("lang", F.col("band").alias("other_band"), F.col("groups").alias("other_groups"))
    place = ["lang", "chunk", "band"]
    work = (chunks.join(bands, "lang").join(other, "lang").where("other_band >= band")
            .join(tiles.select(*place, "cells"), place, "left")
            .join(tiles.select("lang", "chunk", F.col("band").alias("other_band"), F.col("cells").alias("other_cells"))
                  .alias("o"), ["lang", "chunk", "other_band"], "left")
            .withColumn("other_cells", F.when(F.col("other_band") != F.col("band"), F.col("other_cells"))))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    half = (work.repartition(parts, "lang", "chunk", "band", "other_band").mapInArrow(price_tiles, _PRICED)
            .groupBy("lang", "source", "other").agg(F.sum("value").alias("value")))
    pairs = (half.select("lang", F.explode(F.array(
                F.struct("source", F.col("other").alias("item"), "value"),
                F.struct(F.col("other").alias("source"), F.col("source").alias("item"), "value"))).alias("p"))
             .select("lang", "p.*").withColumn("rank", F.row_number().over(group)))
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank")


#: The audit of ``documents`` in SQL: joint tables are left out, every term is priced.
SQL = f"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         coalesce(text, '') as text from documents),
tok as (
  select r, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
kept as (
  select lang, term, count(*) as total from tok group by lang, term having count(distinct r) >= {LEAST_DOCS}),
n as (select lang, source, term, count(*) as n from tok join kept using (lang, term) group by all),
lg as (select lang, sum(total) as big_n, count(*) as v from kept group by lang),
g as (
  select a.lang, a.source, coalesce(sum(n.n), 0) as big_n
  from (select distinct lang, source from d) a left join n on n.lang = a.lang and n.source = a.source group by all),
p as (
  select g.lang, g.source, kept.term, coalesce(n.n, 0) as c,
         1 + ({SCALE}::hugeint * (coalesce(n.n, 0) + {SMOOTH})) // (g.big_n + {SMOOTH} * lg.v) as p,
         1 + ({SCALE}::hugeint * (kept.total + {SMOOTH})) // (lg.big_n + {SMOOTH} * lg.v) as q
  from g join kept on kept.lang = g.lang join lg on lg.lang = g.lang
  left join n on n.lang = g.lang and n.source = g.source and n.term = kept.term),
sums as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pair as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
term as (select lang, source, 'term' as part, term as item, p - q as value from p where c > 0 and p > q)
select lang, source, part, item, value::bigint as value,
       row_number() over (partition by lang, source, part order by value desc, item)::integer as rank
from (select * from pair union all select * from term)
qualify part = 'pair' or rank <= {TOP}
"""
