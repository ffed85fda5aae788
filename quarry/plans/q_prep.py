"""Split (E*) and preprocessing (F*) queries on REG and CLS. Fitting always uses
the train side of the seeded random split (p = 0.2, seed 42)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import sql_hash_unit
from quarry.operators import preprocess as P
from quarry.operators import splits as E
from quarry.plans.registry import register, rnd
from quarry.plans.views import cls, reg, with_views

SEED, P_VAL = 42, 0.2


def Q(views, body, *dbl):
    return rnd(with_views(*views) + body, *dbl)


def _split_sql(name, src, order_key="row_id"):
    return f""", {name} AS (
  SELECT row_id, CASE WHEN row_number() OVER (ORDER BY h, {order_key}) - 1 < ceil((SELECT count(*) FROM {src}) * {P_VAL}::DOUBLE)
                      THEN 'val' ELSE 'train' END AS split
  FROM (SELECT row_id, {sql_hash_unit(SEED, 'row_id')} AS h FROM {src}))
"""


# The hash of a null key is that of the seed alone.
_GROUP_HASH = f"CASE WHEN quantity IS NULL THEN ('0x' || substr(md5('{SEED}'), 1, 8))::BIGINT ELSE {sql_hash_unit(SEED, 'quantity')} END"
REG_SPLIT = _split_sql("sp", "reg")
CLS_SPLIT = _split_sql("csp", "cls")
REG_TRAIN = REG_SPLIT + ", tr AS (SELECT * FROM reg WHERE row_id IN (SELECT row_id FROM sp WHERE split = 'train'))\n"
CLS_TRAIN = CLS_SPLIT + ", ctr AS (SELECT * FROM cls WHERE row_id IN (SELECT row_id FROM csp WHERE split = 'train'))\n"


def reg_split(spark, sf_dir):
    return E.split_random(reg(spark, sf_dir), "row_id", P_VAL, SEED)


def cls_split(spark, sf_dir):
    return E.split_random(cls(spark, sf_dir), "row_id", P_VAL, SEED)


def reg_rule(spark, sf_dir):
    """The split of :func:`reg_split` as a filter."""
    return E.random_rule(reg(spark, sf_dir), "row_id", P_VAL, SEED)


def cls_rule(spark, sf_dir):
    return E.random_rule(cls(spark, sf_dir), "row_id", P_VAL, SEED)


def reg_train(spark, sf_dir):
    return E.apply_split(reg(spark, sf_dir), reg_rule(spark, sf_dir), "row_id", "train")


def cls_train(spark, sf_dir):
    return E.apply_split(cls(spark, sf_dir), cls_rule(spark, sf_dir), "row_id", "train")


# ------------------------------------------------------------------ E
@register("split_random", Q(["reg"], REG_SPLIT + "SELECT row_id, split FROM sp"))
def q_split_random(spark, sf_dir):
    """20 % validation in md5 order."""
    return reg_split(spark, sf_dir)


@register("split_group", Q(["reg"], f""",
g AS (SELECT l_orderkey, CASE WHEN row_number() OVER (ORDER BY {sql_hash_unit(SEED, 'l_orderkey')}, l_orderkey) - 1
                                   < ceil((SELECT count(DISTINCT l_orderkey) FROM reg) * {P_VAL}::DOUBLE) THEN 'val' ELSE 'train' END AS split
      FROM (SELECT DISTINCT l_orderkey FROM reg))
SELECT row_id, split FROM reg JOIN g USING (l_orderkey)"""))
def q_split_group(spark, sf_dir):
    """Whole orders on one side."""
    return E.split_group(reg(spark, sf_dir), "row_id", "l_orderkey", P_VAL, SEED)


@register("split_stratified", Q(["cls"], f"""
SELECT row_id, CASE WHEN r < ceil(n * {P_VAL}::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM (
  SELECT row_id, row_number() OVER (PARTITION BY status ORDER BY {sql_hash_unit(SEED, 'row_id')}, row_id) - 1 AS r,
         count(*) OVER (PARTITION BY status) AS n FROM cls)"""))
def q_split_strat(spark, sf_dir):
    """Class-proportional split of CLS by order status."""
    return E.split_stratified(cls(spark, sf_dir), "row_id", "status", P_VAL, SEED)


@register("split_time", Q(["reg"], f"""
SELECT row_id, CASE WHEN row_number() OVER (ORDER BY l_shipdate, row_id) - 1 >= n - ceil(n * {P_VAL}::DOUBLE) THEN 'val' ELSE 'train' END AS split
FROM reg, (SELECT count(*) AS n FROM reg)"""))
def q_split_time(spark, sf_dir):
    """The latest 20 % of REG by ship date are validation."""
    return E.split_time(reg(spark, sf_dir), "row_id", "l_shipdate", P_VAL)


@register("apply_split", Q(["reg"], REG_TRAIN + "SELECT row_id, quantity FROM tr", "quantity"))
def q_apply_split(spark, sf_dir):
    """Train rows of REG."""
    return reg_train(spark, sf_dir).select("row_id", "quantity")


@register("split_counts", Q(["reg"], REG_SPLIT + "SELECT 'random' AS strategy, split, count(*) AS rows FROM sp GROUP BY split"))
def q_split_counts(spark, sf_dir):
    """E7."""
    return E.split_counts(reg_split(spark, sf_dir), "random")


@register("kfold_assign", Q(["cls"], f"SELECT row_id, {sql_hash_unit(SEED, 'row_id')} % 5 AS fold FROM cls"))
def q_kfold(spark, sf_dir):
    """5 md5 folds."""
    return E.kfold_assign(cls(spark, sf_dir), "row_id", 5, SEED)


@register("kfold_assign_stratified", Q(["cls"], f"""
SELECT row_id, (row_number() OVER (PARTITION BY status ORDER BY {sql_hash_unit(SEED, 'row_id')}, row_id) - 1) % 5 AS fold FROM cls"""))
def q_kfold_strat(spark, sf_dir):
    """Stratified 5 folds (round-robin in md5 order inside each class)."""
    return E.kfold_assign(cls(spark, sf_dir), "row_id", 5, SEED, label="status")


# Null keys: quantity is null in about a fiftieth of REG, and the label below in a fifth of CLS.
@register("split_group_null_keys", Q(["reg"], f""",
g AS (SELECT quantity, CASE WHEN row_number() OVER (ORDER BY {_GROUP_HASH}, quantity NULLS FIRST) - 1
                                 < ceil((SELECT count(*) FROM (SELECT DISTINCT quantity FROM reg)) * {P_VAL}::DOUBLE) THEN 'val' ELSE 'train' END AS split
      FROM (SELECT DISTINCT CAST(quantity AS BIGINT) AS quantity FROM reg))
SELECT row_id, split FROM reg JOIN g ON CAST(reg.quantity AS BIGINT) IS NOT DISTINCT FROM g.quantity"""))
def q_split_group_null(spark, sf_dir):
    """E2 with a nullable group: rows without a quantity stay together on one side."""
    return E.split_group(reg(spark, sf_dir).withColumn("quantity", F.col("quantity").cast("bigint")), "row_id", "quantity", P_VAL, SEED)


def _nullable_label(spark, sf_dir):
    return cls(spark, sf_dir).select("row_id", F.nullif("priority", F.lit("5-LOW")).alias("y"))


@register("split_stratified_null_labels", Q(["cls"], f"""
SELECT row_id, CASE WHEN r < ceil(n * {P_VAL}::DOUBLE) THEN 'val' ELSE 'train' END AS split FROM (
  SELECT row_id, row_number() OVER (PARTITION BY y ORDER BY {sql_hash_unit(SEED, 'row_id')}, row_id) - 1 AS r,
         count(*) OVER (PARTITION BY y) AS n FROM (SELECT row_id, nullif(priority, '5-LOW') AS y FROM cls))"""))
def q_split_strat_null(spark, sf_dir):
    """E3 with a nullable label: rows without one are split like a class."""
    return E.split_stratified(_nullable_label(spark, sf_dir), "row_id", "y", P_VAL, SEED)


@register("kfold_assign_null_labels", Q(["cls"], f"""
SELECT row_id, (row_number() OVER (PARTITION BY y ORDER BY {sql_hash_unit(SEED, 'row_id')}, row_id) - 1) % 5 AS fold
FROM (SELECT row_id, nullif(priority, '5-LOW') AS y FROM cls)"""))
def q_kfold_null(spark, sf_dir):
    """E8 stratified with a nullable label."""
    return E.kfold_assign(_nullable_label(spark, sf_dir), "row_id", 5, SEED, label="y")


@register("resample_null_labels", Q(["cls"], f""",
c AS (SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY {sql_hash_unit(0, 'row_id')}, row_id) - 1 AS r, count(*) OVER (PARTITION BY y) AS n
      FROM (SELECT row_id, nullif(priority, '5-LOW') AS y FROM cls)),
e AS (SELECT max(n) AS mx, min(n) AS mn FROM c)
SELECT row_id, CAST(mx // n + CASE WHEN r < mx % n THEN 1 ELSE 0 END AS BIGINT) AS oversampled, CAST(CASE WHEN r < mn THEN 1 ELSE 0 END AS BIGINT) AS undersampled
FROM c, e"""))
def q_resample_null(spark, sf_dir):
    """G14 and G15 with a nullable label: how often each row comes out."""
    from quarry.operators import models as G
    rows = _nullable_label(spark, sf_dir)
    over = G.oversample(rows, "y", "row_id").groupBy("row_id").agg(F.count(F.lit(1)).alias("oversampled"))
    under = G.undersample(rows, "y", "row_id").select("row_id", F.lit(1).alias("undersampled"))
    return rows.select("row_id").join(over, "row_id", "left").join(under, "row_id", "left").fillna(0)


# ------------------------------------------------------------------ F1-F5
@register("impute_mean", Q(["reg"], REG_TRAIN + "SELECT row_id, coalesce(quantity, (SELECT avg(quantity) FROM tr)) AS quantity FROM reg", "quantity"))
def q_imp_mean(spark, sf_dir):
    """train mean fills missing quantity."""
    fills = P.fit_impute(reg_train(spark, sf_dir), ["quantity"], "mean")
    return P.apply_impute(reg(spark, sf_dir).select("row_id", "quantity"), fills)


@register("impute_median", Q(["reg"], REG_TRAIN + "SELECT row_id, coalesce(quantity, (SELECT quantile_cont(quantity, 0.5) FROM tr)) AS quantity FROM reg", "quantity"))
def q_imp_median(spark, sf_dir):
    """exact train median."""
    fills = P.fit_impute(reg_train(spark, sf_dir), ["quantity"], "median")
    return P.apply_impute(reg(spark, sf_dir).select("row_id", "quantity"), fills)


@register("impute_most_frequent", Q(["reg"], REG_TRAIN + """
SELECT row_id, coalesce(quantity, (SELECT quantity FROM tr WHERE quantity IS NOT NULL GROUP BY quantity ORDER BY count(*) DESC, quantity LIMIT 1)) AS quantity
FROM reg""", "quantity"))
def q_imp_mode(spark, sf_dir):
    """train mode (ties -> smallest)."""
    fills = P.fit_impute(reg_train(spark, sf_dir), ["quantity"], "most_frequent")
    return P.apply_impute(reg(spark, sf_dir).select("row_id", "quantity"), fills)


@register("impute_constant", Q(["reg"], "SELECT row_id, coalesce(quantity, 0.0) AS quantity FROM reg", "quantity"))
def q_imp_const(spark, sf_dir):
    """F3."""
    fills = P.fit_impute(reg(spark, sf_dir), ["quantity"], "constant", 0.0)
    return P.apply_impute(reg(spark, sf_dir).select("row_id", "quantity"), fills)


@register("scale_standard", Q(["reg"], REG_TRAIN + """,
m AS (SELECT avg(quantity) AS mq FROM tr),
it AS (SELECT coalesce(quantity, (SELECT mq FROM m)) AS q, discount FROM tr),
st AS (SELECT avg(q) AS aq, coalesce(nullif(stddev_pop(q), 0), 1.0) AS sq, avg(discount) AS ad, coalesce(nullif(stddev_pop(discount), 0), 1.0) AS sd FROM it)
SELECT row_id, (coalesce(quantity, (SELECT mq FROM m)) - (SELECT aq FROM st)) / (SELECT sq FROM st) AS num__quantity,
       (discount - (SELECT ad FROM st)) / (SELECT sd FROM st) AS num__discount FROM reg""", "num__quantity", "num__discount"))
def q_scale_std(spark, sf_dir):
    """mean imputation then standard scaling (population sd) fitted on train."""
    tr = reg_train(spark, sf_dir)
    fills = P.fit_impute(tr, ["quantity"], "mean")
    sc = P.fit_scale(P.apply_impute(tr, fills), ["quantity", "discount"], "standard")
    out = P.apply_scale(P.apply_impute(reg(spark, sf_dir), fills), sc, prefix="num__")
    return out.select("row_id", "num__quantity", "num__discount")


@register("scale_minmax", Q(["reg"], REG_TRAIN + """
SELECT row_id, (tax - (SELECT min(tax) FROM tr)) / (SELECT coalesce(nullif(max(tax) - min(tax), 0), 1.0) FROM tr) AS num__tax FROM reg""", "num__tax"))
def q_scale_minmax(spark, sf_dir):
    """min-max scaling fitted on train (not clipped)."""
    sc = P.fit_scale(reg_train(spark, sf_dir), ["tax"], "minmax")
    return P.apply_scale(reg(spark, sf_dir), sc, prefix="num__").select("row_id", "num__tax")


# ------------------------------------------------------------------ F7-F11
_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("encode_onehot", Q(["cls"], "SELECT row_id, " + ", ".join(
    f"""CASE WHEN priority = '{v}' THEN 1.0 ELSE 0.0 END AS "cat__priority_{v}\"""" for v in _PRIOS)
    + " FROM cls WHERE (SELECT count(DISTINCT priority) FROM cls) = 5", *[f'"cat__priority_{v}"' for v in _PRIOS]))
def q_onehot(spark, sf_dir):
    """one 0/1 column per sorted train category of order priority."""
    cats = P.fit_onehot(cls_train(spark, sf_dir), ["priority"])
    return P.apply_onehot(cls(spark, sf_dir).select("row_id", "priority"), cats).drop("priority")


@register("encode_onehot_sparse", Q(["cls"], CLS_TRAIN + """,
d AS (SELECT f, v, row_number() OVER (ORDER BY f, v) - 1 AS i FROM (SELECT DISTINCT 0 AS f, cname AS v FROM ctr UNION SELECT DISTINCT 1, priority FROM ctr))
SELECT row_id, (SELECT count(*) FROM d) AS size, concat_ws(',', CAST(a.i AS VARCHAR), CAST(b.i AS VARCHAR)) AS indices,
       CASE WHEN a.i IS NULL THEN 0 ELSE 1 END + CASE WHEN b.i IS NULL THEN 0 ELSE 1 END AS total
FROM cls LEFT JOIN d a ON a.f = 0 AND a.v = cname LEFT JOIN d b ON b.f = 1 AND b.v = priority""", "total"))
def q_onehot_sparse(spark, sf_dir):
    """F7 sparse: customer name and priority as (size, indices, values); names unseen in train have no index."""
    dictionary = P.onehot_dictionary(cls_train(spark, sf_dir), ["cname", "priority"])
    out = P.apply_onehot_sparse(cls(spark, sf_dir).select("row_id", "cname", "priority"), dictionary, ["cname", "priority"])
    return out.select("row_id", F.col("cat__size").alias("size"), F.array_join(F.transform("cat__indices", lambda i: i.cast("string")), ",").alias("indices"),
                      F.aggregate("cat__values", F.lit(0.0), lambda a, v: a + v).alias("total"))


@register("encode_ordinal", Q(["cls"], CLS_TRAIN + """,
lk AS (SELECT segment AS v, row_number() OVER (ORDER BY segment) - 1 AS code FROM (SELECT DISTINCT segment FROM ctr WHERE segment IS NOT NULL))
SELECT row_id, coalesce(code::DOUBLE, -1.0) AS cat__segment FROM cls LEFT JOIN lk ON segment = v""", "cat__segment"))
def q_ordinal(spark, sf_dir):
    """F8: index of the market segment among sorted train values (unseen -1)."""
    lk = P.fit_ordinal(cls_train(spark, sf_dir), ["segment"])
    return P.apply_lookup(cls(spark, sf_dir).select("row_id", "segment"), lk, ["segment"], "code", -1).select("row_id", "cat__segment")


@register("encode_frequency", Q(["cls"], CLS_TRAIN + """,
lk AS (SELECT segment AS v, count(*)::DOUBLE / (SELECT count(*) FROM ctr) AS f FROM ctr GROUP BY segment)
SELECT row_id, coalesce(f, 0.0) AS cat__segment FROM cls LEFT JOIN lk ON segment IS NOT DISTINCT FROM v""", "cat__segment"))
def q_frequency(spark, sf_dir):
    """train share of each segment value (unseen 0)."""
    lk = P.fit_frequency(cls_train(spark, sf_dir), ["segment"])
    return P.apply_lookup(cls(spark, sf_dir).select("row_id", "segment"), lk, ["segment"], "freq", 0.0).select("row_id", "cat__segment")


@register("encode_hashing", Q(["reg"], "SELECT row_id, " + ", ".join(
    f"CASE WHEN {sql_hash_unit(0, chr(39) + 'returnflag=' + chr(39) + ' || coalesce(returnflag, ' + chr(39) + '__MISSING__' + chr(39) + ')')} % 8 = {i} "
    f"THEN 1.0 ELSE 0.0 END AS cat__returnflag__hash_{i}" for i in range(8)) + " FROM reg",
    *[f"cat__returnflag__hash_{i}" for i in range(8)]))
def q_hashing(spark, sf_dir):
    """md5 bucket of "returnflag=value" into 8 columns."""
    return P.apply_hashing(reg(spark, sf_dir).select("row_id", "returnflag"), ["returnflag"], 8).drop("returnflag")


_TM = """,
g AS (SELECT avg(target) AS g FROM tr),
lk AS (SELECT 'returnflag' AS feature, returnflag AS v, (count(*) * avg(target) + 10.0 * (SELECT g FROM g)) / (count(*) + 10.0) AS enc FROM tr GROUP BY returnflag
       UNION ALL
       SELECT 'l_suppkey', CAST(l_suppkey AS VARCHAR), (count(*) * avg(target) + 10.0 * (SELECT g FROM g)) / (count(*) + 10.0) FROM tr GROUP BY l_suppkey)
SELECT row_id, coalesce(a.enc, (SELECT g FROM g)) AS cat__returnflag, coalesce(b.enc, (SELECT g FROM g)) AS cat__l_suppkey
FROM reg LEFT JOIN (SELECT * FROM lk WHERE feature = 'returnflag') a ON returnflag IS NOT DISTINCT FROM a.v
         LEFT JOIN (SELECT * FROM lk WHERE feature = 'l_suppkey') b ON CAST(l_suppkey AS VARCHAR) IS NOT DISTINCT FROM b.v"""


@register("encode_target_mean", Q(["reg"], REG_TRAIN + _TM, "cat__returnflag", "cat__l_suppkey"))
def q_target_mean(spark, sf_dir):
    """smoothed target mean (s = 10) of return flag and supplier; unseen -> global mean."""
    tr = reg_train(spark, sf_dir)
    lk, g = P.fit_target_mean(tr, ["returnflag", "l_suppkey"], "target")
    out = P.apply_lookup(reg(spark, sf_dir).select("row_id", "returnflag", "l_suppkey"), lk, ["returnflag", "l_suppkey"], "enc", g)
    return out.select("row_id", "cat__returnflag", "cat__l_suppkey")


@register("encode_target_mean_oof", Q(["reg"], REG_SPLIT + f""",
tr AS (SELECT r.*, {sql_hash_unit(SEED, 'r.row_id')} % 5 AS fold FROM reg r JOIN sp ON r.row_id = sp.row_id WHERE split = 'train'),
tot AS (SELECT returnflag AS v, count(*) AS n, sum(target) AS s FROM tr GROUP BY 1),
byf AS (SELECT returnflag AS v, fold, count(*) AS nf, sum(target) AS sf FROM tr GROUP BY 1, 2),
gf AS (SELECT fold, ((SELECT sum(target) FROM tr) - sum(target)) / ((SELECT count(*) FROM tr) - count(*)) AS gm FROM tr GROUP BY fold),
oof AS (SELECT byf.v, byf.fold, ((s - sf) + 10.0 * gm) / ((n - nf) + 10.0) AS enc FROM byf JOIN tot USING (v) JOIN gf USING (fold)),
full_ AS (SELECT v, (s + 10.0 * (SELECT avg(target) FROM tr)) / (n + 10.0) AS enc FROM tot)
SELECT r.row_id, CASE WHEN sp.split = 'train' THEN o.enc ELSE coalesce(f.enc, (SELECT avg(target) FROM tr)) END AS cat__returnflag
FROM reg r JOIN sp ON r.row_id = sp.row_id
LEFT JOIN oof o ON sp.split = 'train' AND o.v IS NOT DISTINCT FROM r.returnflag AND o.fold = {sql_hash_unit(SEED, 'r.row_id')} % 5
LEFT JOIN full_ f ON f.v IS NOT DISTINCT FROM r.returnflag""", "cat__returnflag"))
def q_target_oof(spark, sf_dir):
    """out-of-fold target encoding of the return flag (5 md5 folds)."""
    from quarry.functions.hashing import hash_bucket
    r = reg(spark, sf_dir).select("row_id", "returnflag", "target").withColumn("fold", hash_bucket(SEED, "row_id", 5))
    sp = reg_split(spark, sf_dir)
    return P.target_mean_oof(r, sp, "row_id", ["returnflag"], "target").select("row_id", "cat__returnflag")


@register("encode_target_label", Q(["cls"], """
SELECT row_id, CAST(CASE WHEN status = 'F' THEN 1 ELSE 0 END AS BIGINT) AS label_index FROM cls"""))
def q_target_label(spark, sf_dir):
    """two-class label (no / yes) to 0 / 1 by sorted class."""
    c = cls(spark, sf_dir).select("row_id", F.when(F.col("status") == "F", "yes").otherwise("no").alias("y"))
    out, _ = P.label_encode(c, "y", "binary")
    return out.select("row_id", "label_index")


@register("label_encode", Q(["cls"], """
SELECT row_id, CAST(CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS BIGINT) AS label_index FROM cls"""))
def q_label_encode(spark, sf_dir):
    """order status classes sorted to 0..k-1."""
    out, _ = P.label_encode(cls(spark, sf_dir), "status", "multiclass")
    return out.select("row_id", "label_index")


@register("encoding_report", Q(["cls"], CLS_TRAIN + """,
u AS (SELECT 'priority' AS "column", 'onehot' AS encoding, count(DISTINCT priority) AS train_uniques FROM ctr
      UNION ALL SELECT 'segment', 'frequency', count(DISTINCT segment) FROM ctr
      UNION ALL SELECT 'cname', 'hashing', count(DISTINCT cname) FROM ctr)
SELECT "column", encoding, train_uniques, CAST(CASE encoding WHEN 'hashing' THEN 64 WHEN 'frequency' THEN 1 ELSE train_uniques END AS BIGINT) AS encoded_dim,
       CAST(sum(CASE encoding WHEN 'hashing' THEN 64 WHEN 'frequency' THEN 1 ELSE train_uniques END) OVER () AS BIGINT) AS total_dim FROM u"""))
def q_enc_report(spark, sf_dir):
    """per column encoding, train uniques and encoded width."""
    return P.encoding_report(cls_train(spark, sf_dir), {"priority": "onehot", "segment": "frequency", "cname": "hashing"})


def _hash_cols(col, n=16):
    tok = f"'{col}=' || coalesce(CAST({col} AS VARCHAR), '__MISSING__')"
    return ", ".join(f"CASE WHEN {sql_hash_unit(0, tok)} % {n} = {i} THEN 1.0 ELSE 0.0 END AS cat__{col}__hash_{i}" for i in range(n))


_ONEHOT_PRIO = ", ".join("CASE WHEN priority = '%s' THEN 1.0 ELSE 0.0 END AS \"cat__priority_%s\"" % (v, v) for v in _PRIOS)
_DBL_PRIO = [f'"cat__priority_{v}"' for v in _PRIOS]


@register("encode_auto", Q(["cls"], CLS_TRAIN + f"""
SELECT row_id, {_ONEHOT_PRIO}, {_hash_cols('cname')} FROM cls
WHERE (SELECT count(DISTINCT priority) FROM ctr) = 5 AND (SELECT count(DISTINCT cname) FROM ctr) > 50""",
                                  *_DBL_PRIO, *[f"cat__cname__hash_{i}" for i in range(16)]))
def q_encode_auto(spark, sf_dir):
    """one-hot for low-cardinality columns, hashing (16 buckets) above 50 train values."""
    tr = cls_train(spark, sf_dir)
    encs = P.auto_encodings(tr, ["priority", "cname"])
    c = cls(spark, sf_dir).select("row_id", "priority", "cname")
    oh = [k for k, v in encs.items() if v == "onehot"]
    hs = [k for k, v in encs.items() if v == "hashing"]
    out = P.apply_hashing(P.apply_onehot(c, P.fit_onehot(tr, oh)), hs, 16)
    return out.drop("priority", "cname")


@register("encode_composite", Q(["cls"], CLS_TRAIN + f""",
o AS (SELECT segment AS v, row_number() OVER (ORDER BY segment) - 1 AS code FROM (SELECT DISTINCT segment FROM ctr WHERE segment IS NOT NULL)),
fq AS (SELECT priority AS v, count(*)::DOUBLE / (SELECT count(*) FROM ctr) AS f FROM ctr GROUP BY priority)
SELECT row_id, coalesce(o.code::DOUBLE, -1.0) AS cat__segment, coalesce(fq.f, 0.0) AS cat__priority, {_hash_cols('cname')}
FROM cls LEFT JOIN o ON segment = o.v LEFT JOIN fq ON priority IS NOT DISTINCT FROM fq.v""",
                                       "cat__segment", "cat__priority", *[f"cat__cname__hash_{i}" for i in range(16)]))
def q_encode_composite(spark, sf_dir):
    """ordinal for segment, frequency for priority, hashing for customer name, side by side."""
    tr = cls_train(spark, sf_dir)
    c = cls(spark, sf_dir).select("row_id", "segment", "priority", "cname")
    out = P.apply_lookup(c, P.fit_ordinal(tr, ["segment"]), ["segment"], "code", -1)
    out = P.apply_lookup(out, P.fit_frequency(tr, ["priority"]), ["priority"], "freq", 0.0)
    return P.apply_hashing(out, ["cname"], 16).drop("segment", "priority", "cname")


_PFT_STATS = ", ".join(
    f"avg({c}) AS a_{c}, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS s_{c}" for c in ["q", "discount", "tax"])


@register("preprocess_fit_transform", Q(["reg"], REG_TRAIN + f""",
m AS (SELECT avg(quantity) AS mq, avg(discount) AS md, avg(tax) AS mt FROM tr),
it AS (SELECT coalesce(quantity, (SELECT mq FROM m)) AS q, discount, tax FROM tr),
st AS (SELECT {_PFT_STATS} FROM it)
SELECT row_id, target,
       (coalesce(quantity, (SELECT mq FROM m)) - (SELECT a_q FROM st)) / (SELECT s_q FROM st) AS num__quantity,
       (coalesce(discount, (SELECT md FROM m)) - (SELECT a_discount FROM st)) / (SELECT s_discount FROM st) AS num__discount,
       (coalesce(tax, (SELECT mt FROM m)) - (SELECT a_tax FROM st)) / (SELECT s_tax FROM st) AS num__tax,
       {", ".join(f"CASE WHEN coalesce(returnflag, '__MISSING__') = '{v}' THEN 1.0 ELSE 0.0 END AS cat__returnflag_{v}" for v in "ANR")},
       {", ".join(f"CASE WHEN coalesce(linestatus, '__MISSING__') = '{v}' THEN 1.0 ELSE 0.0 END AS cat__linestatus_{v}" for v in "FO")}
FROM reg WHERE (SELECT count(DISTINCT returnflag) FROM tr) = 3 AND (SELECT count(DISTINCT linestatus) FROM tr) = 2""",
                                               "target", "num__quantity", "num__discount", "num__tax",
                                               *[f"cat__returnflag_{v}" for v in "ANR"], *[f"cat__linestatus_{v}" for v in "FO"]))
def q_preprocess(spark, sf_dir):
    """F16: numeric impute + scale, categorical one-hot, fitted on the REG train rows."""
    r = reg(spark, sf_dir)
    return P.preprocess_fit_transform(r, reg_rule(spark, sf_dir), "row_id", ["quantity", "discount", "tax"],
                                      ["returnflag", "linestatus"], "target")
