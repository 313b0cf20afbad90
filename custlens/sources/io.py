"""CSV inputs with explicit schemas, score tables and the submission file."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampType)

# The reference's input column names.
CATEGORICAL = ("crd_card_act_ind", "atdd_type", "gdr_cd", "mrg_situ_cd", "edu_deg_cd", "ic_ind",
               "fr_or_sh_ind", "dnl_mbl_bnk_ind", "dnl_bind_cmb_lif_ind", "hav_car_grp_ind",
               "hav_hou_grp_ind", "l6mon_agn_ind", "vld_rsk_ases_ind", "loan_act_ind",
               "acdm_deg_cd", "deg_cd", "bk1_cur_year_mon_avg_agn_amt_cd",
               "l1y_crd_card_csm_amt_dlm_cd", "l6mon_daim_aum_cd", "perm_crd_lmt_cd",
               "pl_crd_lmt_cd")

# The product features (out -> factors), and the counts whose sum and
# smoothed ratios are features.
PRODUCTS = {"cur_debit_rate": ("cur_debit_min_opn_dt_cnt", "cur_debit_cnt"),
            "cur_credit_rate": ("cur_credit_min_opn_dt_cnt", "cur_credit_cnt"),
            "creditrate1": ("l1y_crd_card_csm_amt_dlm_cd", "cur_credit_min_opn_dt_cnt"),
            "creditrate2": ("perm_crd_lmt_cd", "cur_credit_min_opn_dt_cnt"),
            "creditrate3": ("l1y_crd_card_csm_amt_dlm_cd", "perm_crd_lmt_cd")}
RATIO_COLUMNS = ("l12mon_buy_fin_mng_whl_tms", "l12_mon_fnd_buy_whl_tms", "l12_mon_gld_buy_whl_tms")
RATIO_SUM = "l12mon_buy_sum"

TRD_SCHEMA = StructType([
    StructField("id", StringType()), StructField("Dat_Flg1_Cd", StringType()),
    StructField("Dat_Flg3_Cd", StringType()), StructField("Trx_Cod1_Cd", StringType()),
    StructField("Trx_Cod2_Cd", StringType()), StructField("trx_tm", TimestampType()),
    StructField("cny_trx_amt", DoubleType()),
])

IMPORTANCE_SCHEMA = StructType([
    StructField("feature", StringType()),
    StructField("importance_gain", DoubleType()), StructField("importance_split", LongType()),
    StructField("trn_score", DoubleType()),
])


def _typed(name: str, kind: DataType) -> Column:
    """A text column as ``kind``; a value that doesn't parse is an error, not a NULL."""
    c = F.col(f"`{name}`")
    value = c.try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"{name}: not a {kind.simpleString()}: "), c)).cast(kind)
    return F.when(c.isNull() | value.isNotNull(), value).otherwise(bad).alias(name)


def mark_rejects(raw: DataFrame, schema: StructType) -> DataFrame:
    """The text columns of ``schema`` by name: ``good`` (a struct of typed values),
    ``bad_columns`` (names of those whose text doesn't parse) and ``raw`` (the texts)."""
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    bad = [F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(), F.lit(f.name))
           for f in schema.fields]
    texts = F.create_map(*[x for f in schema.fields for x in (F.lit(f.name), F.col(f"`{f.name}`").cast("string"))])
    return raw.select(F.struct(*typed).alias("good"), F.array_compact(F.array(*bad)).alias("bad_columns"),
                      texts.alias("raw"))


def set_rejects_apart(raw: DataFrame, schema: StructType, path: str, source: str,
                      most: int | None = None) -> tuple[DataFrame, int]:
    """The typed rows of ``raw`` that parse, and how many don't.  Those are appended to the
    parquet table ``path`` as ``source, bad_columns, raw``, counted as they are written;
    more than ``most`` of them are an error (after the write, so that they can be read)."""
    marked = mark_rejects(raw, schema)
    seen = Observation()
    (marked.where(F.size("bad_columns") > 0).select(F.lit(source).alias("source"), "bad_columns", "raw")
     .observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path))
    n = seen.get["n"]
    if most is not None and n > most:
        raise ValueError(f"{source}: {n} rows don't parse, {most} are allowed; they are in {path}")
    return marked.where(F.size("bad_columns") == 0).select("good.*"), n


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             rejects: str | None = None, most_rejects: int | None = None) -> DataFrame:
    """Headered CSV.  Without a schema every column is read as text (sentinel
    columns must stay text until they are cleaned).  With one, its columns are taken
    by name, whatever their order and whichever others there are.  A value that doesn't
    parse is an error, or sets its row apart in the table ``rejects`` where that is given
    (up to ``most_rejects`` rows)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if schema is None:
        return raw
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    if rejects is not None:
        return set_rejects_apart(raw, schema, rejects, path, most_rejects)[0]
    return raw.select(*[_typed(f.name, f.dataType) for f in schema.fields])


def read_customers(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Customer CSV as text columns plus ``split``; ``flag`` cast to int when present."""
    df = read_csv(spark, path).withColumn("split", F.lit(split))
    if "flag" in df.columns:
        df = df.withColumn("flag", F.col("flag").cast("int"))
    return df


def read_transactions(spark: SparkSession, path: str, split: str, rejects: str | None = None,
                      most_rejects: int | None = None) -> DataFrame:
    return read_csv(spark, path, TRD_SCHEMA, rejects, most_rejects).withColumn("split", F.lit(split))


def read_page_views(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Page views: the nameless last column holds the view time.  It is named
    ``page_tm`` and parsed; the other columns keep their header names."""
    raw = read_csv(spark, path)
    last = raw.columns[-1]
    return (raw.withColumn("page_tm", _typed(last, TimestampType())).drop(last)
               .withColumn("split", F.lit(split)))


def read_importances(spark: SparkSession, path: str) -> DataFrame:
    """The columns by name; a nameless row number before them is left out."""
    return read_csv(spark, path, IMPORTANCE_SCHEMA)


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Long score table ``model, fold, id, score`` as parquet partitioned by model."""
    scores.write.mode(mode).partitionBy("model").parquet(path)


def replace_parts(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write ``df`` partitioned ``by``; partitions that it has are replaced, others stay."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where nothing was written yet."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return spark.read.parquet(path)


def table_state(df: DataFrame, *more) -> str:
    """Checksum of a table's rows (in any order), its schema and ``more``."""
    each = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    n, low, high = df.agg(F.count(F.lit(1)), F.sum(each.cast("decimal(38,0)")), F.bit_xor(each)).first()
    return hashlib.sha256(repr((n, str(low), high, df.dtypes, more)).encode()).hexdigest()


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_submission(scores: DataFrame, path: str, key: str = "id", score: str = "score") -> None:
    """``id<TAB>score`` lines, no header."""
    (scores.select(key, score).write.mode("overwrite")
           .option("sep", "\t").option("header", False).csv(path))
