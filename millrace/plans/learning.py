"""Gradient rounds and the learner on the embedding vectors.

A vector is one worker's push: eight workers push per round, and the last,
incomplete round does not count. All vectors belong to one model (key 0).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import learn
from ..session import load
from .registry import query

WORKERS = 8
LENGTH = 64

_CELLS = """
cells AS (SELECT vec_id AS seq, vec_id // 8 AS round, CAST(unnest(embedding) AS DOUBLE) AS v,
  CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS idx FROM embeddings),
init AS (SELECT idx, max(v) AS w FROM cells GROUP BY idx),
sums AS (SELECT round, idx, sum(v) AS total, avg(v) AS mean FROM cells
  GROUP BY round, idx HAVING count(*) = 8)"""


def vector_pushes(spark, sf):
    return load(spark, sf, "embeddings").selectExpr(
        "0 AS key", "vec_id AS seq", "vec_id div 8 AS round", "vec_id % 8 AS worker", "embedding AS vec")


def initial(pushes):
    """Starting weights: the largest value at each position."""
    highest = pushes.groupBy("key").agg(F.array(*[
        F.max(F.get("vec", F.lit(i)).cast("double")) for i in range(LENGTH)]).alias("w"))
    return highest.select("key", F.posexplode("w").alias("idx", "w"))


@query("grad_mean_round", f"WITH {_CELLS} SELECT round, idx, round(mean, 6) AS val FROM sums")
def grad_mean_round(spark, sf):
    rounds = learn.gradient_rounds(vector_pushes(spark, sf), WORKERS, "mean", LENGTH)
    return rounds.select("round", "idx", F.round("val", 6).alias("val"))


@query("grad_sum_round", f"WITH {_CELLS} SELECT round, idx, round(total, 6) AS val FROM sums")
def grad_sum_round(spark, sf):
    rounds = learn.gradient_rounds(vector_pushes(spark, sf), WORKERS, "sum", LENGTH)
    return rounds.select("round", "idx", F.round("val", 6).alias("val"))


@query("vector_sum_round", f"""
WITH {_CELLS} SELECT round, idx, round(w + sum(total) OVER (PARTITION BY idx ORDER BY round), 5) AS w
FROM sums JOIN init USING (idx)""")
def vector_sum_round(spark, sf):
    pushes = vector_pushes(spark, sf)
    sums = learn.round_sums(pushes, initial(pushes), WORKERS, LENGTH)
    return sums.select("round", "idx", F.round("w", 5).alias("w"))


@query("vector_add_async", f"""
WITH {_CELLS} SELECT seq, idx, round(w + sum(v) OVER (PARTITION BY idx ORDER BY seq), 5) AS w
FROM cells JOIN init USING (idx)""")
def vector_add_async(spark, sf):
    pushes = vector_pushes(spark, sf)
    return learn.async_sums(pushes, initial(pushes)).select("seq", "idx", F.round("w", 5).alias("w"))


@query("sgd_sync", f"""
WITH {_CELLS} SELECT round, idx, round(w - 0.1 * sum(total) OVER (PARTITION BY idx ORDER BY round), 5) AS w
FROM sums JOIN init USING (idx)""")
def sgd_sync(spark, sf):
    pushes = vector_pushes(spark, sf)
    steps = learn.sgd_sync(pushes, initial(pushes), WORKERS, 0.1, LENGTH)
    return steps.select("round", "idx", F.round("w", 5).alias("w"))


@query("sgd_async", f"""
WITH {_CELLS} SELECT seq, idx, round(w - 0.1 * sum(v) OVER (PARTITION BY idx ORDER BY seq), 5) AS w
FROM cells JOIN init USING (idx)""")
def sgd_async(spark, sf):
    pushes = vector_pushes(spark, sf)
    return learn.sgd_async(pushes, initial(pushes), 0.1).select("seq", "idx", F.round("w", 5).alias("w"))


# z and n grow without bound in this variant; they are shown by leading digits
_LEADING_SQL = "printf('%.7e', z) AS z, printf('%.7e', n) AS n, round(w, 5) AS w"


def _ftrl_sql(steps: str, shown: str) -> str:
    return f"""
WITH RECURSIVE {_CELLS},
steps AS ({steps}),
state AS (
  SELECT CAST(-1 AS BIGINT) AS o, idx, CAST(0 AS DOUBLE) AS z, CAST(0 AS DOUBLE) AS n, w FROM init
  UNION ALL
  SELECT o, idx, z1, n1, CASE WHEN abs(z1) < 0.01 THEN 0 ELSE
    ((CASE WHEN z1 > 0 THEN 0.01 ELSE -0.01 END) - z1) / ((CAST(1 AS DOUBLE) + sqrt(n1)) / CAST(0.1 AS DOUBLE) + CAST(0.0005 AS DOUBLE)) END
  FROM (SELECT o, idx, z1, n + z1 * z1 AS n1 FROM (
    SELECT steps.o, idx, n, z + g - w / CAST(0.1 AS DOUBLE) * (sqrt(n + z * z) - sqrt(n)) AS z1
    FROM state JOIN steps USING (idx) WHERE steps.o = state.o + 1)))
SELECT idx, {shown} FROM state
WHERE o = (SELECT max(o) FROM steps)"""


@query("ftrl_sync", _ftrl_sql("SELECT round AS o, idx, mean AS g FROM sums", _LEADING_SQL))
def ftrl_sync(spark, sf):
    pushes = vector_pushes(spark, sf)
    rounds = learn.gradient_rounds(pushes, WORKERS, "mean", LENGTH)
    return _shown(learn.ftrl_fold(rounds, initial(pushes), "round"))


@query("ftrl_async", _ftrl_sql("SELECT seq AS o, idx, v AS g FROM cells", _LEADING_SQL))
def ftrl_async(spark, sf):
    pushes = vector_pushes(spark, sf)
    return _shown(learn.ftrl_fold(learn.unfold(pushes, "seq"), initial(pushes), "seq"))


@query("ftrl_published", _ftrl_sql("SELECT round AS o, idx, mean AS g FROM sums", _LEADING_SQL)
       .replace("n + z1 * z1 AS n1", "n + g * g AS n1").replace("SELECT steps.o, idx, n, z + g", "SELECT steps.o, idx, n, g, z + g")
       .replace("sqrt(n + z * z)", "sqrt(n + g * g)"))
def ftrl_published(spark, sf):
    """The published form of the update, with few positions in a block."""
    pushes = vector_pushes(spark, sf)
    rounds = learn.gradient_rounds(pushes, WORKERS, "mean", LENGTH)
    settings = learn.Ftrl(variant="published")
    return _shown(learn.ftrl_fold(rounds, initial(pushes), "round", settings, block_bits=3))


def _shown(state):
    return state.select("idx", F.format_string("%.7e", "z").alias("z"),
                        F.format_string("%.7e", "n").alias("n"), F.round("w", 5).alias("w"))


def train_model(spark, sf, epochs=2):
    rows = load(spark, sf, "embeddings").select(
        "vec_id", "embedding", (F.col("label") == 0).cast("int").alias("y"))
    return learn.train(rows, "embedding", "y", F.col("vec_id") % WORKERS, WORKERS, LENGTH, epochs)


def _train_sql(epochs: int) -> str:
    """The rounds written out: each epoch's gradient, then the update of every weight."""
    text = """
WITH cells AS (SELECT vec_id, CAST(label = 0 AS INT) AS y, CAST(unnest(embedding) AS DOUBLE) AS x,
  CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS idx FROM embeddings),
s0 AS (SELECT DISTINCT idx, CAST(0 AS DOUBLE) AS z, CAST(0 AS DOUBLE) AS n, CAST(0 AS DOUBLE) AS w FROM cells)"""
    for e in range(epochs):
        text += f""",
m{e} AS (SELECT vec_id, sum(x * w) AS m FROM cells JOIN s{e} USING (idx) GROUP BY vec_id),
g{e} AS (SELECT idx, sum((1 / (1 + exp(-m)) - y) * x) / 8 AS g FROM cells JOIN m{e} USING (vec_id) GROUP BY idx),
z{e} AS (SELECT idx, n, z + g - w / CAST(0.1 AS DOUBLE) * (sqrt(n + z * z) - sqrt(n)) AS z FROM s{e} JOIN g{e} USING (idx)),
s{e + 1} AS (SELECT idx, z, n + z * z AS n, CASE WHEN abs(z) < 0.01 THEN 0 ELSE
  ((CASE WHEN z > 0 THEN 0.01 ELSE -0.01 END) - z) / ((CAST(1 AS DOUBLE) + sqrt(n + z * z)) / CAST(0.1 AS DOUBLE) + CAST(0.0005 AS DOUBLE)) END AS w
  FROM z{e})"""
    return text


@query("lr_train", _train_sql(2) + """
SELECT idx, round(z, 4) AS z, round(n, 4) AS n, round(w, 4) AS w FROM s2""")
def lr_train(spark, sf):
    return train_model(spark, sf).select("idx", *[F.round(c, 4).alias(c) for c in ("z", "n", "w")])


@query("lr_predict_table", """
SELECT vec_id, CAST(list_sum(list_transform(range(1, 65), lambda i:
  CAST(embedding[i] AS DOUBLE) * (i - 32.5) / 64)) >= 0 AS INT) AS predicted FROM embeddings""")
def lr_predict_table(spark, sf):
    """The model as a table, joined by position."""
    weights = spark.range(LENGTH).select(F.col("id").cast("int").alias("idx"), ((F.col("id") - 31.5) / LENGTH).alias("w"))
    rows = load(spark, sf, "embeddings").select("vec_id", "embedding")
    return learn.predict_table(rows, "vec_id", "embedding", weights).select("vec_id", "predicted")


@query("lr_predict", """
SELECT vec_id, CAST(list_sum(list_transform(range(1, 65), lambda i:
  CAST(embedding[i] AS DOUBLE) * (i - 32.5) / 64)) >= 0 AS INT) AS predicted FROM embeddings""")
def lr_predict(spark, sf):
    weights = [(i - 32.5) / LENGTH for i in range(1, LENGTH + 1)]
    return learn.predict(load(spark, sf, "embeddings"), "embedding", weights).select("vec_id", "predicted")


@query("lr_train_sparse", """
WITH dense AS (SELECT vec_id, CAST(label = 0 AS INT) AS y, CAST(unnest(embedding) AS DOUBLE) AS x,
  CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS i FROM embeddings),
cells AS (SELECT vec_id, y, x, vec_id % 7 * 64 + i AS idx FROM dense WHERE abs(x) >= 0.125),
s0 AS (SELECT DISTINCT idx, CAST(0 AS DOUBLE) AS z, CAST(0 AS DOUBLE) AS n, CAST(0 AS DOUBLE) AS w FROM cells)"""
       + _train_sql(2).split("FROM cells)", 1)[1] + """
SELECT idx, round(z, 4) AS z, round(n, 4) AS n, round(w, 4) AS w FROM s2""")
def lr_train_sparse(spark, sf):
    """Sparse rows of crossed features: the large components, apart by the remainder of the row's number."""
    rows = load(spark, sf, "embeddings").select(F.col("vec_id").alias("row"), (F.col("label") == 0).cast("int").alias("y"), "embedding")
    cells = rows.select("row", F.posexplode("embedding").alias("i", "v")).select(
        "row", (F.col("row") % 7 * 64 + F.col("i")).alias("idx"), F.col("v").cast("double").alias("x")).where("abs(x) >= 0.125")
    model = learn.train_sparse(cells, rows.select("row", "y"), WORKERS, 2)
    return model.select("idx", *[F.round(c, 4).alias(c) for c in ("z", "n", "w")])
