"""End-to-end plans: raw tables -> one wide feature row per customer -> scores.

``build_features`` is the whole feature step of the reference as one lazy
DataFrame: cleaning, cross features, the transaction profile, day gaps of
transactions and page views, optional token embeddings, weight of evidence
and category money encodings.  Every family is keyed by ``id`` and
left-joined onto the customers.

``score_customers`` selects features by importance, assigns stratified
folds, fits out-of-fold boosted trees for each model variant and blends the
scores.  The feature table is checkpointed (to the cluster's checkpoint
directory) before training, because every boosting round re-reads it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custlens.operators import clean, encode, model, select, sequence
from custlens.operators.profile import FAMILIES, attach, transaction_profile
from custlens.operators.temporal import gap_stats
from custlens.session import ensure_checkpoint_dir
from custlens.sources import io as sio
from custlens.sources.facts import Facts, stage_facts

#: Columns of the transactions that the features read.
FACT_COLUMNS = ("id", "trx_tm", "amt", "flg1", "flg3", "cod1", "cod2")


def build_features(users: DataFrame, trd: DataFrame | Facts, beh: DataFrame | None = None,
                   categorical: Sequence[str] = (), woe_cols: Sequence[str] | None = None,
                   money_cols: Sequence[str] | None = None,
                   products: dict[str, tuple[str, str]] | None = None,
                   ratio_cols: Sequence[str] = (), ratio_sum: str = "l12mon_buy_sum",
                   families: Sequence[str] = FAMILIES, embed: bool = False,
                   order: Sequence[str] = ("trx_tm",), scoring_copies: int = 1,
                   clean_text: bool = True, money_scale: int | None = 2,
                   max_len: int = sequence.MAX_LEN) -> DataFrame:
    """Wide per-customer feature table.

    ``users``: ``id, split`` (train / score), ``flag`` on train rows and the
    attributes; ``trd``: ``id, trx_tm, amt, flg1, flg3, cod1, cod2``; ``beh``:
    ``id, page_tm``.  ``woe_cols`` / ``money_cols`` default to ``categorical``.
    Embedding columns are named ``0`` to ``5``, as importance tables name them.
    ``money_scale``: decimals of the amounts; ``max_len``: tokens of a chunk of a
    customer's sequence (embedding contexts don't cross chunks).  The transactions are
    staged by customer first, unless they come staged: the families by customer then
    share one exchange of them and one count of the hot customers.
    """
    cats = list(categorical)
    if not isinstance(trd, Facts):
        trd = stage_facts(trd.select(*dict.fromkeys([*FACT_COLUMNS, *order])), "id", ["trx_tm"])
    base = users
    if clean_text:
        base = clean.null_sentinels(base, categorical=cats)
        base = clean.infer_numeric(base, skip=["id", "split", *cats])
    if products:
        base = encode.product_features(base, products)
    if ratio_cols:
        base = encode.ratio_features(base, ratio_cols, ratio_sum)
    # Encodings are fitted on the customer table itself: their data-dependent
    # decisions (class-size guard, cardinality bounds) then run small jobs on
    # that table rather than on the joined wide table.  The families are
    # independent, so they are planned on a few driver threads: their small
    # decision jobs (guards, bounds, hot-key counts) run concurrently.
    woe = cats if woe_cols is None else list(woe_cols)
    money = cats if money_cols is None else list(money_cols)

    def woe_piece():
        w = encode.woe_encode(base, woe)
        return w.select("id", *[c for c in w.columns if c.endswith(encode.WOE_SUFFIX)])

    def money_piece():
        m = encode.category_money(base, trd, money, scoring_copies=scoring_copies,
                                  money_scale=money_scale)
        return m.select("id", *[f"{c}{s}" for c in money for s in encode.MONEY_STATS])

    def embed_piece():
        seqs = trd.by_key(lambda rows, hot: sequence.token_sequences(
            rows, "id", "cod2", list(order), max_len=max_len, hot_rows=hot))
        vocab = sequence.vocabulary(sequence.fit_embedding(seqs, max_len=max_len))
        return sequence.token_mean_vectors(trd.rows(), "id", "cod2", vocab, dim=6, prefix="")

    def customer_piece(rows, hot):
        # Every customer of the rows is in the profile; both are keyed as the rows lie.
        prof = transaction_profile(rows, families, money_scale=money_scale, hot_rows=hot)
        return prof.join(gap_stats(rows, "id", "trx_tm", hot_rows=hot), "id", "left")

    tasks = [lambda: trd.by_key(customer_piece)]
    if beh is not None:
        tasks.append(lambda: gap_stats(beh, "id", "page_tm", suffix="2"))
    if embed:
        tasks.append(embed_piece)
    if woe:
        tasks.append(woe_piece)
    if money:
        tasks.append(money_piece)
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        pieces = [f.result() for f in [pool.submit(t) for t in tasks]]
    out = base
    for piece in pieces:
        out = attach(out, piece)
    return out


def score_customers(features: DataFrame, trd: DataFrame, null_imp: DataFrame | None = None,
                    actual_imp: DataFrame | None = None, categorical: Sequence[str] = (),
                    model_ids: Sequence[int] = (1, 2, 3), max_iter: int = 20,
                    narrow: bool = True, scores_path: str | None = None,
                    absent: Sequence[str] = ()) -> Scored:
    """Blended scores per scoring customer, the fold AUC table, and the AUC by round and
    split counts of the models.  With ``scores_path`` the scores of each model and fold are
    written there as soon as a model is done, its AUCs and split counts beside them, and
    the blend is made from what was written; a rerun on the same inputs fits only the
    models that are not there yet.  A selected feature that the table lacks is an error
    unless it is named in ``absent``.

    Feature selection (when importance tables are given) keeps the features
    whose gain score reaches 40 plus every ``*_crossentroy`` column.  Model 1
    indexes categories, model 2 one-hot encodes them, model 3 replaces the
    selected categorical columns by their money encodings.
    """
    spark = features.sparkSession
    ensure_checkpoint_dir(spark)
    id_cols = {"id", "flag", "split"}
    feats = [c for c in features.columns if c not in id_cols]
    if null_imp is not None and actual_imp is not None:
        kept = {r["feature"] for r in
                select.select_features(select.importance_scores(null_imp, actual_imp)).collect()}
        missing = sorted(kept - set(feats) - set(absent))
        if missing:
            raise ValueError(f"selected features that the table lacks: {', '.join(missing)}")
        feats = [c for c in feats if c in kept or encode.WOE_SUFFIX in c]
    if not feats:
        raise ValueError("feature selection kept no column of the feature table")
    cats = [c for c in categorical if c in feats]
    # The whole feature plan runs once; folds, narrowing and models read its result.
    features = features.select("id", "flag", "split", *feats).checkpoint()
    train = clean.mark_member(features.where(F.col("split") == "train"), trd.select("id"),
                              "id", "has_trx")
    train = model.assign_folds(train, "id", "has_trx")
    rest = (features.where(F.col("split") != "train")
            .withColumn("has_trx", F.lit(None).cast("int")).withColumn("fold", F.lit(None).cast("int")))
    data = train.unionByName(rest).select("id", "flag", "split", "fold", *feats)
    if narrow:
        # The selected features are narrowed before training (doubles whose
        # range allows it become float), as the reference does.
        data = clean.narrow_types(data, skip=["id", "flag", "fold"])
    data = data.checkpoint()
    numeric = [c for c, t in data.select(*feats).dtypes if c not in cats and t != "string"]
    def fit(m: int) -> model.OofFit:
        if m == 3 and cats:
            # Categories replaced by their money encodings (computed here for
            # the ones the feature table does not carry yet).
            money = [f"{c}{st}" for c in cats for st in encode.MONEY_STATS]
            need = [c for c in cats if f"{c}{encode.MONEY_STATS[0]}" not in data.columns]
            enc = encode.category_money(data, trd, need) if need else data
            # Every boosting round reads the encodings again.
            enc = enc.drop(*cats).checkpoint()
            m_numeric = list(dict.fromkeys(numeric + [c for c in money if c in enc.columns]))
            return model.oof_fit(enc, m_numeric, [], model_id=m, max_iter=max_iter)
        return model.oof_fit(data, numeric, cats, model_id=m, max_iter=max_iter,
                             encoding="onehot" if m == 2 else "index")

    store = ModelStore(spark, scores_path, (data, trd.select("id", "amt") if 3 in model_ids and cats else None),
                       (numeric, cats, max_iter, model.SEED)) if scores_path else None
    todo = [m for m in model_ids if store is None or not store.has(m)]
    # The model variants are independent: fit them on concurrent driver
    # threads so their boosting rounds share the cluster.
    fits: list[model.OofFit] = []
    failed = None
    with ThreadPoolExecutor(max_workers=max(1, len(todo))) as pool:
        running = {pool.submit(fit, m): m for m in todo}
        for done in as_completed(running):
            try:
                fits.append(done.result())
                if store is not None:
                    store.put(running[done], fits[-1])
            except Exception as e:  # the others still finish and are kept
                failed = failed or e
    if failed is not None:
        raise failed
    if store is not None:
        scores, rounds, splits = (t.where(F.col("model").isin(list(model_ids))) for t in store.tables())
    else:
        scores, rounds, splits = (reduce(DataFrame.unionByName, [getattr(f, t) for f in fits])
                                  for t in ModelStore.TABLES)
    aucs = rounds.where("best").select("model", "fold", "auc", "n_pos", "n_neg")
    return Scored(model.blend(scores), aucs, rounds, splits)


@dataclass
class Scored:
    """What ``score_customers`` returns; unpacks to the first two."""

    blended: DataFrame   # id, score
    fold_auc: DataFrame  # model, fold, auc, n_pos, n_neg of the chosen rounds
    rounds: DataFrame    # model, fold, round, auc, n_pos, n_neg, best
    splits: DataFrame    # model, feature, splits

    def __iter__(self) -> Iterator[DataFrame]:
        return iter((self.blended, self.fold_auc))


class ModelStore:
    """Results of finished models under ``path`` (scores, by model and fold), with the AUCs
    by round, the split counts and a manifest in tables beside it.  The manifest names the
    state of the inputs that a model was fitted on; it is written last, so a model that
    was interrupted counts as missing and its partitions are replaced."""

    TABLES = ("scores", "rounds", "splits")

    def __init__(self, spark: SparkSession, path: str, inputs: Sequence[DataFrame | None], settings: tuple):
        self.spark, self.path = spark, path.rstrip("/")
        self.state = sio.table_state(inputs[0], settings, *[sio.table_state(t) for t in inputs[1:] if t is not None])

    def _at(self, table: str) -> str:
        return self.path if table == "scores" else f"{self.path}_{table}"

    def has(self, m: int) -> bool:
        known = sio.read_parts(self.spark, self._at("manifest"))
        return known is not None and bool(known.where((F.col("model") == m) & (F.col("state") == self.state)).limit(1).count())

    def put(self, m: int, fit: model.OofFit) -> None:
        for table in self.TABLES:
            by = ["model", "fold"] if table == "scores" else ["model"]
            sio.replace_parts(getattr(fit, table), self._at(table), by)
        sio.replace_parts(self.spark.createDataFrame([(m, self.state)], "model int, state string"),
                          self._at("manifest"), ["model"])

    def tables(self) -> list[DataFrame]:
        return [self.spark.read.parquet(self._at(t)) for t in self.TABLES]


# The reference's transaction column names.
TRD_COLUMNS = {"Dat_Flg1_Cd": "flg1", "Dat_Flg3_Cd": "flg3", "Trx_Cod1_Cd": "cod1",
               "Trx_Cod2_Cd": "cod2", "cny_trx_amt": "amt"}


def standardize_transactions(trd: DataFrame) -> DataFrame:
    """Rename the reference's transaction columns to the engine's names."""
    return trd.select(*[F.col(c).alias(TRD_COLUMNS.get(c, c)) for c in trd.columns])


def score_from_files(spark, customers: dict[str, str], transactions: dict[str, str],
                 page_views: dict[str, str], out_dir: str, categorical: Sequence[str] | None = None,
                 null_importances: str | None = None, actual_importances: str | None = None,
                 model_ids: Sequence[int] = (1, 2, 3), max_iter: int = 20,
                 scoring_copies: int = 1, embed: bool = True,
                 absent: Sequence[str] = (), money_scale: int | None = 2,
                 max_len: int = sequence.MAX_LEN, most_rejects: int | None = None) -> DataFrame:
    """Files in, scores out: ``customers`` / ``transactions`` / ``page_views``
    map a split name (``train``, ``score``) to a CSV path.  Writes the blended
    scores as ``id<TAB>score`` and the per-model scores, fold AUCs and split counts as
    parquet under ``out_dir``; returns the blended scores.  ``most_rejects``: transactions
    that don't parse are set apart under ``out_dir``, up to so many a file (None: the
    first one is an error).  A rerun fits only what ``out_dir`` lacks."""
    categorical = sio.CATEGORICAL if categorical is None else categorical

    def union(frames):
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    rejects = None if most_rejects is None else f"{out_dir.rstrip('/')}/rejects"
    users = clean.require_unique(
        union([sio.read_customers(spark, p, split) for split, p in customers.items()]))
    trd = standardize_transactions(
        union([sio.read_transactions(spark, p, split, rejects, most_rejects) for split, p in transactions.items()]))
    beh = union([sio.read_page_views(spark, p, split) for split, p in page_views.items()])
    # Cross features of the columns that the files have.
    products = {o: p for o, p in sio.PRODUCTS.items() if set(p) <= set(users.columns)}
    ratios = sio.RATIO_COLUMNS if set(sio.RATIO_COLUMNS) <= set(users.columns) else ()
    feats = build_features(users, trd, beh, categorical=categorical, embed=embed,
                           scoring_copies=scoring_copies, products=products,
                           ratio_cols=ratios, ratio_sum=sio.RATIO_SUM, money_scale=money_scale,
                           max_len=max_len)
    null_imp = sio.read_importances(spark, null_importances) if null_importances else None
    act_imp = sio.read_importances(spark, actual_importances) if actual_importances else None
    mode_cols = [c for c in ("dat3_mode", "trx1_mode", "trx2_mode", "week_mode2",
                             "weekday_mode2") if c in feats.columns]
    got = score_customers(feats, trd, null_imp, act_imp, categorical=mode_cols,
                          model_ids=model_ids, max_iter=max_iter,
                          scores_path=f"{out_dir.rstrip('/')}/scores", absent=absent)
    sio.write_submission(got.blended, f"{out_dir.rstrip('/')}/submission")
    got.fold_auc.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/fold_auc")
    return got.blended
