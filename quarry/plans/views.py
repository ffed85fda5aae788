"""Derived views over the driver tables that play the roles of the reference's
test fixtures (REG, CLS, PRED_R, PRED_C, PRED_M, RUNS, TEXTY, LEAK).

Each view has a Spark builder and a DuckDB twin (``SQL_VIEWS``) with the same
arithmetic in the same order, so doubles agree bit for bit. Every view reads the
whole source table; nothing is sub-setted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.hashing import HASH_RANGE, hash_uniform, sql_hash_unit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table. A file with a single row group scans as one task; such
    an under-partitioned input is spread over the cores (no-op for large inputs)."""
    from quarry.functions.ranking import spread
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _flag(c, v):
    return F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0))


# ---------------------------------------------------------------- REG
def reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    row_id = F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         F.col("l_quantity").cast("bigint"))
    li = li.withColumn("row_id", row_id)
    target = (
        F.lit(2) * F.col("l_quantity") - F.lit(30) * F.col("l_discount") + F.lit(5) * _flag("l_returnflag", "R")
        + (hash_uniform(11, "row_id") - F.lit(0.5)) * F.lit(4)
    )
    return li.select(
        "row_id", "l_orderkey", "l_suppkey", "l_shipdate",
        F.nullif(F.col("l_quantity"), F.lit(50.0)).alias("quantity"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("returnflag"), F.col("l_linestatus").alias("linestatus"),
        target.alias("target"),
    )


def pred_r(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reg(spark, sf_dir)
    y_pred = (F.lit(1.9) * F.coalesce(F.col("quantity"), F.lit(25.0)) - F.lit(20) * F.col("discount")
              + F.lit(1.5) * _flag("returnflag", "R") + F.lit(1.0))
    return r.select("row_id", "l_suppkey", F.col("target").alias("y_true"), y_pred.alias("y_pred"))


# ---------------------------------------------------------------- CLS
def cls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(
        F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("totalprice"), F.col("o_orderpriority").alias("priority"),
        F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("cname"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").cast("bigint").alias("nationkey"),
        F.col("o_orderdate").alias("orderdate"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("label"),
    )


def pred_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cls(spark, sf_dir)
    p = F.lit(0.35) * F.col("label") + F.lit(0.65) * hash_uniform(7, "row_id")
    return c.select("row_id", "segment", F.col("label").alias("y_true"), p.alias("p")).withColumn(
        "y_pred", F.when(F.col("p") >= 0.5, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))


# The three order-status classes, sorted.
CLASSES = ["F", "O", "P"]


def pred_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cls(spark, sf_dir)
    idx = F.when(F.col("status") == "F", 0).when(F.col("status") == "O", 1).otherwise(2).cast("bigint")
    c = c.withColumn("y_true", idx)
    for k in range(3):
        c = c.withColumn(f"s{k}", hash_uniform(20 + k, "row_id") + F.lit(0.6) * F.when(F.col("y_true") == k, 1.0).otherwise(0.0))
    tot = F.col("s0") + F.col("s1") + F.col("s2")
    c = c.select("row_id", "segment", "y_true", *[(F.col(f"s{k}") / tot).alias(f"p{k}") for k in range(3)])
    best = (F.when((F.col("p0") >= F.col("p1")) & (F.col("p0") >= F.col("p2")), 0)
            .when(F.col("p1") >= F.col("p2"), 1).otherwise(2).cast("bigint"))
    return c.withColumn("y_pred", best).withColumn("proba", F.array("p0", "p1", "p2"))


# ---------------------------------------------------------------- RUNS
# The four reference predictors, their run order and family.
RUN_MODELS = ["m_lin", "m_qty", "m_const", "m_noisy"]


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression metrics of four fixed predictors per supplier (one board per supplier)."""
    r = reg(spark, sf_dir)
    qf = F.coalesce(F.col("quantity"), F.lit(25.0))
    lin = (F.lit(1.9) * qf - F.lit(20) * F.col("discount") + F.lit(1.5) * _flag("returnflag", "R") + F.lit(1.0))
    preds = {
        "m_lin": lin,
        "m_qty": F.lit(2) * qf,
        "m_const": F.lit(50.0),
        "m_noisy": lin + (hash_uniform(13, "row_id") - F.lit(0.5)) * F.lit(10),
    }
    longp = r.select(
        F.col("l_suppkey").alias("board"), F.col("target").alias("y"),
        F.explode(F.array(*[F.struct(F.lit(i).cast("bigint").alias("run_order"), F.lit(m).alias("model"), e.alias("p"))
                            for i, (m, e) in enumerate(preds.items())])).alias("s"),
    ).select("board", "y", "s.run_order", "s.model", "s.p")
    m = longp.groupBy("board", "model", "run_order").agg(
        F.avg((F.col("y") - F.col("p")) * (F.col("y") - F.col("p"))).alias("mse"),
        F.avg(F.abs(F.col("y") - F.col("p"))).alias("mae"),
        F.sum((F.col("y") - F.col("p")) * (F.col("y") - F.col("p"))).alias("sse"),
        (F.var_pop("y") * F.count(F.lit(1))).alias("sst"),
        F.count(F.lit(1)).alias("n"),
    )
    hb = hash_uniform(5, "board")
    return m.select(
        "board", F.concat_ws("-", F.lit("b"), F.col("board").cast("string"), F.col("model")).alias("run_id"),
        "model", "run_order",
        F.when(F.col("model") == "m_noisy", F.lit("ensemble")).otherwise(F.lit("single")).alias("family"),
        F.lit("r2").alias("primary_metric"), F.lit("maximize").alias("direction"),
        F.lit("ds1").alias("dataset_id"),
        F.when((F.col("model") == "m_qty") & (hb < 0.1), F.lit("split_b")).otherwise(F.lit("split_a")).alias("split_hash"),
        F.lit("recipe1").alias("recipe_hash"),
        F.when((F.col("model") == "m_const") & (hb >= 0.9), F.lit(None).cast("bigint")).otherwise(F.lit(42).cast("bigint")).alias("seed"),
        F.when(F.col("sst") == 0, F.when(F.col("sse") == 0, 1.0).otherwise(0.0))
        .otherwise(F.lit(1.0) - F.col("sse") / F.col("sst")).alias("r2"),
        F.sqrt("mse").alias("rmse"), "mae", "mse", "n",
    )


SQL_VIEWS = {
    "reg": f"""reg AS (
  SELECT row_id, l_orderkey, l_suppkey, l_shipdate, nullif(l_quantity, 50.0) AS quantity,
         l_discount AS discount, l_tax AS tax, l_extendedprice AS price,
         l_returnflag AS returnflag, l_linestatus AS linestatus,
         2 * l_quantity - 30 * l_discount + 5 * (CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE
           + ({sql_hash_unit(11, 'row_id')} / {HASH_RANGE}::DOUBLE - 0.5::DOUBLE) * 4 AS target
  FROM (SELECT *, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)) AS row_id
        FROM lineitem))""",
    "pred_r": """pred_r AS (
  SELECT row_id, l_suppkey, target AS y_true,
         1.9::DOUBLE * coalesce(quantity, 25.0::DOUBLE) - 20 * discount
           + 1.5::DOUBLE * (CASE WHEN returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE + 1.0::DOUBLE AS y_pred
  FROM reg)""",
    "cls": """cls AS (
  SELECT o_orderkey AS row_id, o_orderstatus AS status, o_totalprice AS totalprice, o_orderpriority AS priority,
         c_mktsegment AS segment, c_name AS cname, c_acctbal AS acctbal, CAST(c_nationkey AS BIGINT) AS nationkey,
         o_orderdate AS orderdate, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS label
  FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "pred_c": f"""pred_c AS (
  SELECT row_id, segment, label AS y_true, p, CAST(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS y_pred
  FROM (SELECT *, 0.35::DOUBLE * label + 0.65::DOUBLE * ({sql_hash_unit(7, 'row_id')} / {HASH_RANGE}::DOUBLE) AS p FROM cls))""",
    "pred_m": f"""pred_m AS (
  SELECT row_id, segment, y_true, p0, p1, p2,
         CAST(CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS BIGINT) AS y_pred
  FROM (SELECT row_id, segment, y_true, s0 / (s0 + s1 + s2) AS p0, s1 / (s0 + s1 + s2) AS p1, s2 / (s0 + s1 + s2) AS p2
        FROM (SELECT row_id, segment, y_true,
                     {sql_hash_unit(20, 'row_id')} / {HASH_RANGE}::DOUBLE + 0.6::DOUBLE * (CASE WHEN y_true = 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS s0,
                     {sql_hash_unit(21, 'row_id')} / {HASH_RANGE}::DOUBLE + 0.6::DOUBLE * (CASE WHEN y_true = 1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS s1,
                     {sql_hash_unit(22, 'row_id')} / {HASH_RANGE}::DOUBLE + 0.6::DOUBLE * (CASE WHEN y_true = 2 THEN 1.0 ELSE 0.0 END)::DOUBLE AS s2
              FROM (SELECT row_id, segment, CAST(CASE WHEN status = 'F' THEN 0 WHEN status = 'O' THEN 1 ELSE 2 END AS BIGINT) AS y_true FROM cls))))""",
    "runs": f"""runs AS (
  SELECT board, 'b-' || CAST(board AS VARCHAR) || '-' || model AS run_id, model, run_order,
         CASE WHEN model = 'm_noisy' THEN 'ensemble' ELSE 'single' END AS family,
         'r2' AS primary_metric, 'maximize' AS direction, 'ds1' AS dataset_id,
         CASE WHEN model = 'm_qty' AND hb < 0.1 THEN 'split_b' ELSE 'split_a' END AS split_hash,
         'recipe1' AS recipe_hash,
         CASE WHEN model = 'm_const' AND hb >= 0.9 THEN NULL ELSE CAST(42 AS BIGINT) END AS seed,
         CASE WHEN sst = 0 THEN (CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END)::DOUBLE ELSE 1.0::DOUBLE - sse / sst END AS r2,
         sqrt(mse) AS rmse, mae, mse, n
  FROM (SELECT board, model, run_order, avg((y - p) * (y - p)) AS mse, avg(abs(y - p)) AS mae,
               sum((y - p) * (y - p)) AS sse, var_pop(y) * count(*) AS sst, count(*) AS n,
               {sql_hash_unit(5, 'board')} / {HASH_RANGE}::DOUBLE AS hb
        FROM (SELECT l_suppkey AS board, target AS y, run_order, model,
                     CASE model WHEN 'm_lin' THEN lin WHEN 'm_qty' THEN 2 * qf WHEN 'm_const' THEN 50.0::DOUBLE
                          ELSE lin + ({sql_hash_unit(13, 'row_id')} / {HASH_RANGE}::DOUBLE - 0.5::DOUBLE) * 10 END AS p
              FROM (SELECT *, coalesce(quantity, 25.0::DOUBLE) AS qf,
                           1.9::DOUBLE * coalesce(quantity, 25.0::DOUBLE) - 20 * discount
                             + 1.5::DOUBLE * (CASE WHEN returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE + 1.0::DOUBLE AS lin FROM reg) r
              CROSS JOIN (VALUES (0::BIGINT, 'm_lin'), (1::BIGINT, 'm_qty'), (2::BIGINT, 'm_const'), (3::BIGINT, 'm_noisy')) m(run_order, model))
        GROUP BY board, model, run_order))""",
}

# View dependencies, so an oracle query can ask for just what it needs.
_DEPS = {"reg": [], "pred_r": ["reg"], "cls": [], "pred_c": ["cls"], "pred_m": ["cls"], "runs": ["reg"]}


def with_views(*names: str) -> str:
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(SQL_VIEWS[n] for n in order) + "\n"


# ---------------------------------------------------------------- TEXTY / LEAK
def texty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text versions of lineitem columns with injected junk (for coercion / scalar checks)."""
    from quarry.functions.hashing import hash_unit
    li = table(spark, sf_dir, "lineitem")
    li = li.withColumn("row_id", F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                             F.col("l_quantity").cast("bigint")))
    h = hash_unit(3, "row_id")

    def pick(mod, cases, default):
        e = None
        for k, v in cases:
            e = (F.when if e is None else e.when)(F.pmod(h, F.lit(mod)) == k, F.lit(v))
        return e.otherwise(default)

    return li.select(
        "row_id", "l_shipdate",
        pick(17, [(0, "abc"), (1, " 1.5 "), (2, "NaN")], F.col("l_quantity").cast("bigint").cast("string")).alias("num_txt"),
        pick(13, [(0, "2001-13-01"), (1, "not a date")], F.date_format("l_shipdate", "yyyy-MM-dd")).alias("date_txt"),
        pick(7, [(0, "yes"), (1, " N "), (2, "TRUE"), (3, "maybe"), (4, "0"), (5, "t")], F.lit("false")).alias("bool_txt"),
        pick(19, [(0, "12x"), (1, " 7 ")], F.col("l_linenumber").cast("string")).alias("int_txt"),
        pick(5, [(0, "   "), (1, "")], F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" "))).alias("pad_txt"),
        pick(11, [(0, "Completed"), (1, "closed"), (2, "error"), (3, "ABORTED"), (4, "pending"), (5, "in_progress"),
                  (6, " success "), (7, "created")], F.lit("weird")).alias("status_txt"),
    )


def leak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REG plus leak columns (exact copy, copy altered in 1 % of rows, scaled copy), a
    constant column, a record id, and 2 % of rows appended again as duplicates."""
    from quarry.functions.hashing import hash_unit
    r = reg(spark, sf_dir)
    base = r.select(
        "row_id", F.col("row_id").alias("record_id"), "quantity", "discount", "tax", "returnflag", "linestatus", "target",
        F.col("target").alias("leak_exact"),
        F.when(hash_unit(31, "row_id") < F.lit(42949673), F.col("target") + F.lit(1.0)).otherwise(F.col("target")).alias("leak_noisy"),
        (F.col("target") * F.lit(2.0) + F.lit(1.0)).alias("leak_scaled"),
        F.lit("k").alias("const_col"))
    return base.unionByName(base.where(hash_unit(32, "row_id") < F.lit(85899346)))


SQL_VIEWS["texty"] = f"""texty AS (
  SELECT row_id, l_shipdate,
    CASE h % 17 WHEN 0 THEN 'abc' WHEN 1 THEN ' 1.5 ' WHEN 2 THEN 'NaN' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS num_txt,
    CASE h % 13 WHEN 0 THEN '2001-13-01' WHEN 1 THEN 'not a date' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date_txt,
    CASE h % 7 WHEN 0 THEN 'yes' WHEN 1 THEN ' N ' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'maybe' WHEN 4 THEN '0' WHEN 5 THEN 't' ELSE 'false' END AS bool_txt,
    CASE h % 19 WHEN 0 THEN '12x' WHEN 1 THEN ' 7 ' ELSE CAST(l_linenumber AS VARCHAR) END AS int_txt,
    CASE h % 5 WHEN 0 THEN '   ' WHEN 1 THEN '' ELSE '  ' || l_returnflag || ' ' END AS pad_txt,
    CASE h % 11 WHEN 0 THEN 'Completed' WHEN 1 THEN 'closed' WHEN 2 THEN 'error' WHEN 3 THEN 'ABORTED' WHEN 4 THEN 'pending'
                WHEN 5 THEN 'in_progress' WHEN 6 THEN ' success ' WHEN 7 THEN 'created' ELSE 'weird' END AS status_txt
  FROM (SELECT *, {sql_hash_unit(3, 'row_id')} AS h
        FROM (SELECT *, concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)) AS row_id FROM lineitem)))"""
SQL_VIEWS["leak"] = f"""leak0 AS (
  SELECT row_id, row_id AS record_id, quantity, discount, tax, returnflag, linestatus, target, target AS leak_exact,
         CASE WHEN {sql_hash_unit(31, 'row_id')} < 42949673 THEN target + 1.0::DOUBLE ELSE target END AS leak_noisy,
         target * 2.0::DOUBLE + 1.0::DOUBLE AS leak_scaled, 'k' AS const_col
  FROM reg),
leak AS (SELECT * FROM leak0 UNION ALL SELECT * FROM leak0 WHERE {sql_hash_unit(32, 'row_id')} < 85899346)"""
_DEPS.update({"texty": [], "leak": ["reg"]})
