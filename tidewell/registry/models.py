"""Queries over sampling, weights, evaluation, feature selection and models.

Models are fitted on the whole tables.  What a learner finds has no SQL form; the queries show what SQL can state about
it: which rows were scored, that probabilities and importances add up, that quality is above a stated floor.
"""

from __future__ import annotations

import json

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewell.fixtures import DIRTY_SQL, dirty_lineitem, table
from tidewell.functions.splits import split_by_time
from tidewell.operators.approximate import approximate_vectors
from tidewell.operators.balance import class_weights, smote, with_class_weights
from tidewell.operators.evaluation import binary_metrics, class_metrics, confusion_matrix, roc_points
from tidewell.operators.grouping import attach
from tidewell.operators.models import (
    dealt,
    grid_search,
    held_back,
    leaderboard,
    load_model,
    load_newest,
    log_loss,
    model_importance,
    rounds_used,
    save_model,
    save_version,
    score_binary,
    scored_export,
    time_folds,
    train_binary,
    train_forest,
    train_multiclass,
    versions,
)
from tidewell.operators.neighbors import nearest_vectors
from tidewell.operators.sampling import sample_exact
from tidewell.operators.softmax import multiclass_loss, score_softmax, train_softmax
from tidewell.plans.feature_selection import clean_split, feature_importance, select_features, write_reports
from tidewell.registry.base import query
from tidewell.session import durable, scratch_path, settle

FEATURES = ["value", "hour", "k", "user_load"]


def flows(spark, sf_dir):
    """Events with numeric features and a 0/1 label that follows them."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "value",
        F.hour("ts").alias("hour"),
        k.alias("k"),
        (F.col("user_id") % 10).alias("user_load"),
        "event_type",
        ((F.col("value") > 20) | (F.col("event_type") == "error")).cast("int").alias("y"),
    )


SCORED_SQL = """WITH scored AS (
  SELECT CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, (event_id % 97) / 97.0 * 0.5
    + CASE WHEN event_type IN ('error', 'click') THEN 0.4 ELSE 0.0 END AS score FROM events)"""


def scored_events(spark, sf_dir):
    """A deterministic score that leans towards the label."""
    lean = F.when(F.col("event_type").isin("error", "click"), F.lit(0.4)).otherwise(F.lit(0.0))
    return table(spark, sf_dir, "events").select(
        (F.col("event_type") == "error").cast("int").alias("label"),
        ((F.col("event_id") % 97) / F.lit(97.0) * 0.5 + lean).alias("score"),
    )


@query(
    "class_weights",
    """SELECT toxic, count(*) AS n, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
    FROM labels GROUP BY toxic""",
)
def weights(spark, sf_dir):
    return class_weights(table(spark, sf_dir, "labels"), "toxic").withColumn("weight", F.round("weight", 6))


@query("sample_exact", "SELECT CAST(least(10000, count(*)) AS BIGINT) AS n, TRUE AS all_distinct FROM lineitem")
def sample(spark, sf_dir):
    """Size and distinctness of the sample; its members depend on the hash."""
    picked = sample_exact(table(spark, sf_dir, "lineitem"), 10_000)
    return picked.groupBy(*picked.columns).count().agg(
        F.sum("count").alias("n"), (F.count(F.lit(1)) == F.sum("count")).alias("all_distinct")
    )


@query(
    "binary_metrics",
    SCORED_SQL
    + """, ranked AS (SELECT label, avg(r) OVER (PARTITION BY score) AS rank
      FROM (SELECT label, score, row_number() OVER (ORDER BY score) AS r FROM scored)),
    auc AS (SELECT (sum(rank) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / 2.0)
      / (sum(label) * (count(*) - sum(label))) AS auc FROM ranked),
    c AS (SELECT count(*) AS n, avg(-(label * ln(greatest(score, 1e-15)) + (1 - label) * ln(1 - score))) AS logloss,
      count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
      sum(label) AS p FROM scored)
    SELECT n, round(auc, 8) AS auc, round(logloss, 8) AS logloss, round((tp + n - p - fp) / n, 8) AS accuracy,
      round(tp / (tp + fp), 8) AS precision, round(tp / p, 8) AS recall, round(2.0 * tp / (tp + fp + p), 8) AS f1 FROM c, auc""",
)
def metrics(spark, sf_dir):
    found = binary_metrics(scored_events(spark, sf_dir))
    return found.select("n", *[F.round(c, 8).alias(c) for c in found.columns if c != "n"])


@query(
    "confusion_matrix",
    SCORED_SQL + " SELECT label, CAST(score >= 0.5 AS INT) AS prediction, count(*) AS n FROM scored GROUP BY ALL",
)
def confusion(spark, sf_dir):
    called = (F.col("score") >= 0.5).cast("int").alias("prediction")
    return confusion_matrix(scored_events(spark, sf_dir).select("label", called))


@query(
    "class_metrics",
    """WITH s AS (SELECT event_type AS label, CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS prediction FROM events),
    a AS (SELECT label AS class, count(*) AS support, count(*) FILTER (WHERE label = prediction) AS h FROM s GROUP BY label),
    b AS (SELECT prediction AS class, count(*) AS p FROM s GROUP BY prediction)
    SELECT class, support, round(h / p, 8) AS precision, round(h / support, 8) AS recall, round(2.0 * h / (p + support), 8) AS f1
    FROM a JOIN b USING (class)""",
)
def per_class(spark, sf_dir):
    called = F.when(F.col("event_id") % 3 == 0, F.lit("view")).otherwise(F.col("event_type"))
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("label"), called.alias("prediction"))
    return class_metrics(rows).withColumns({c: F.round(c, 8) for c in ("precision", "recall", "f1")})


@query(
    "roc_points",
    SCORED_SQL
    + """, b AS (SELECT least(floor(score / 1.0 * 100), 99) AS bin, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)
    SELECT round(bin / 100, 6) AS threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
      round(sum(pos) OVER w / sum(pos) OVER (), 8) AS tpr, round(sum(neg) OVER w / sum(neg) OVER (), 8) AS fpr,
      round(sum(pos) OVER w / (sum(pos) OVER w + sum(neg) OVER w), 8) AS precision
    FROM b WINDOW w AS (ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def roc(spark, sf_dir):
    points = roc_points(scored_events(spark, sf_dir), bins=100)
    rounded = {c: F.round(c, 8) for c in ("tpr", "fpr", "precision")}
    return points.withColumns({**rounded, "threshold": F.round("threshold", 6)})


@query(
    "smote_balance",
    """SELECT quality, max(count(*)) OVER () AS n, max(count(*)) OVER () - count(*) AS synthetic, TRUE AS inside
    FROM labels JOIN documents USING (doc_id) GROUP BY quality""",
)
def balanced(spark, sf_dir):
    """Class sizes after balancing; synthetic values lie within the range of their class."""
    joined = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    words = F.size(F.split("text", " ")).cast("double")
    rows = joined.select("quality", F.col("n_chars").cast("double").alias("n_chars"), words.alias("words"))
    edges = rows.groupBy("quality").agg(
        *[f(c).alias(f"{t}_{c}") for c in ("n_chars", "words") for t, f in (("lo", F.min), ("hi", F.max))]
    )
    made = smote(rows, ["n_chars", "words"], "quality").join(edges, "quality")
    inside = F.col("n_chars").between(F.col("lo_n_chars"), F.col("hi_n_chars")) & F.col("words").between(
        F.col("lo_words"), F.col("hi_words")
    )
    return made.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("synthetic").alias("synthetic"), F.every(inside).alias("inside")
    )


@query(
    "nearest_vectors",
    """WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
    pairs AS (SELECT a.label, a.vec_id, list_distance(a.x, b.x) AS dist,
        row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x)) AS r
      FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id)
    SELECT label, vec_id, count(*) AS n, round(max(dist), 5) AS farthest, round(sum(dist), 5) AS total
    FROM pairs WHERE r <= 5 GROUP BY label, vec_id""",
)
def neighbors(spark, sf_dir):
    """Five nearest vectors of the same label, cells kept small so that several are probed."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    points = rows.select("label", "x", F.lit(1).cast("long").alias("m")).distinct()
    found = nearest_vectors(points, points, 5, "label", "x", "m", cell_rows=32, chunk_rows=64)
    dist = F.transform("neighbors", lambda s: s["dist"])
    return rows.join(found, ["label", "x"]).select(
        "label",
        "vec_id",
        F.size("neighbors").cast("long").alias("n"),
        F.round(F.array_max(dist), 5).alias("farthest"),
        F.round(F.aggregate(dist, F.lit(0.0), lambda a, b: a + b), 5).alias("total"),
    )


@query(
    "approximate_vectors",
    """SELECT label, count(*) AS n, sum(least(5, c - 1))::BIGINT AS listed, TRUE AS recalled
    FROM (SELECT label, count(*) OVER (PARTITION BY label) AS c FROM embeddings) GROUP BY label""",
)
def recalled_neighbors(spark, sf_dir):
    """Vectors per label, neighbours listed, and whether at least nine tenths of these are the nearest there are."""
    rows = table(spark, sf_dir, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("x"))
    points = rows.groupBy("label", "x").agg(F.count(F.lit(1)).alias("m"))
    near, _ = approximate_vectors(points, points, 5, "label", "x", "m", cell_rows=32, chunk_rows=64)
    names = lambda df, out: df.select("label", "x", F.transform("neighbors", lambda s: s["y"]).alias(out))
    exact = names(nearest_vectors(points, points, 5, "label", "x", "m"), "exact")
    both = rows.join(exact, ["label", "x"], "left").join(names(near, "near"), ["label", "x"], "left")
    hits = F.sum(F.size(F.array_intersect("exact", "near")))
    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("near").cast("long")).alias("listed"), (hits >= 0.9 * F.sum(F.size("exact"))).alias("recalled")
    )


@query(
    "smote_embeddings",
    """WITH c AS (SELECT label, count(*) AS n, max(count(*)) OVER () AS most FROM embeddings GROUP BY label)
    SELECT label, FALSE AS synthetic, n, TRUE AS inside FROM c
    UNION ALL SELECT label, TRUE, most - n, TRUE FROM c WHERE n < most""",
)
def balanced_vectors(spark, sf_dir):
    """All embedding classes raised to the largest, in 64 dimensions, within the range of their class."""
    rows = table(spark, sf_dir, "embeddings")
    width = len(rows.first()["embedding"])
    features = [f"e{i}" for i in range(width)]
    wide = rows.select("label", *[F.col("embedding")[i].cast("double").alias(f) for i, f in enumerate(features)])
    edges = wide.groupBy("label").agg(
        F.array(*[F.min(f) for f in features]).alias("lo"), F.array(*[F.max(f) for f in features]).alias("hi")
    )
    made = smote(wide, features, "label").select("label", "synthetic", F.array(*features).alias("x")).join(edges, "label")
    zipped = F.arrays_zip("x", "lo", "hi")
    inside = F.forall(zipped, lambda z: (z["x"] >= z["lo"] - 1e-9) & (z["x"] <= z["hi"] + 1e-9))
    return made.groupBy("label", "synthetic").agg(F.count(F.lit(1)).alias("n"), F.every(inside).alias("inside"))


def ranking_checks(ranked):
    """Whether ranks are 1..n in order of importance and importances add up to one."""
    listed = F.array_sort(F.collect_list(F.struct("rank", "importance")))
    checked = ranked.agg(listed.alias("l"), F.count(F.lit(1)).alias("n"), F.sum("importance").alias("total"))
    falling = F.forall(
        F.sequence(F.lit(1), F.greatest(F.size("l") - 1, F.lit(1))),
        lambda i: F.coalesce(F.get("l", i - 1)["importance"] >= F.get("l", i)["importance"], F.lit(True)),
    )
    return checked.select(
        "n",
        (F.transform("l", lambda r: r["rank"].cast("int")) == F.sequence(F.lit(1), F.col("n").cast("int"))).alias("ranked"),
        falling.alias("falling"),
        (F.abs(F.col("total") - 1) < 1e-6).alias("sums_to_one"),
    )


@query("feature_importance", "SELECT 4::BIGINT AS n, TRUE AS ranked, TRUE AS falling, TRUE AS sums_to_one FROM events HAVING count(*) > 0")
def importance(spark, sf_dir):
    """The ranking forest with its stated defaults."""
    return ranking_checks(feature_importance(flows(spark, sf_dir), FEATURES, "y", key=["event_id"]))


@query(
    "select_features",
    f"""WITH {DIRTY_SQL}, clean AS (
      SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM dirty
      WHERE rate IS NOT NULL AND NOT isnan(rate) AND note IS NOT NULL),
    low AS (SELECT var_pop(l_discount) <= 0.01 AS discount, var_pop(l_tax) <= 0.01 AS tax FROM clean)
    SELECT * FROM (VALUES ('l_returnflag', 'not_numeric'), ('l_linestatus', 'not_numeric'), ('l_shipdate', 'not_numeric'),
      ('note', 'not_numeric'), ('l_orderkey', 'configured'), ('twin', 'correlated'), ('flat', 'low_variance'))
      AS t(feature, drop_reason)
    UNION ALL SELECT 'l_discount', 'low_variance' FROM low WHERE discount
    UNION ALL SELECT 'l_tax', 'low_variance' FROM low WHERE tax""",
)
def selection(spark, sf_dir):
    """Dirty table, cleaned as one split, filtered and ranked with the stated defaults; reports are written."""
    train = clean_split(dirty_lineitem(spark, sf_dir).drop("source_file"))
    chosen = select_features(train, "Label", drops=["l_orderkey"])
    write_reports(chosen, scratch_path(spark, "selection"))
    fine = ranking_checks(chosen.filter("rank is not null")).first()
    if not (fine["ranked"] and fine["falling"] and fine["sums_to_one"]):
        raise ValueError(f"inconsistent ranking: {fine}")
    return chosen.filter("drop_reason is not null").select("feature", "drop_reason")


@query(
    "selected_features",
    """WITH f AS (SELECT value, hour(ts) AS hour, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k, user_id % 10 AS user_load,
      CASE WHEN value > 20 OR event_type = 'error' THEN 1 ELSE 0 END AS y FROM events),
    c AS (UNPIVOT (SELECT abs(corr(value, y)) AS value, abs(corr(hour, y)) AS hour, abs(corr(k, y)) AS k,
      abs(corr(user_load, y)) AS user_load FROM f) ON value, hour, k, user_load INTO NAME feature VALUE strength)
    SELECT feature, row_number() OVER (ORDER BY strength DESC, feature) = 1 AS selected, TRUE AS in_ranking, TRUE AS in_reports FROM c""",
)
def selected(spark, sf_dir):
    """The one best feature of four, which is the one that correlates most with the label; the three reports read back."""
    kind = F.when(F.col("y") == 1, "attack").otherwise("BENIGN").alias("kind")
    train = durable(flows(spark, sf_dir).select("event_id", *FEATURES, kind), "selection")
    chosen = select_features(train, "kind", "BENIGN", ["event_id"], max_features=1, key=["event_id"], numTrees=20, maxDepth=5)
    chosen = durable(chosen, "chosen")
    folder = scratch_path(spark, "reports")
    write_reports(chosen, folder)
    ranking = spark.read.option("header", "true").schema("feature string, importance double").csv(f"{folder}/feature_importance")
    named = spark.read.schema("selected_features array<string>, count int").json(f"{folder}/selected_features")
    table_lines = spark.read.option("sep", "\t").option("header", "true").csv(f"{folder}/report").select("feature", "rank")
    listed = named.filter(F.size("selected_features") == F.col("count")).select(F.explode("selected_features").alias("feature"))
    told = listed.join(table_lines, "feature").select("feature", F.lit(True).alias("told"))
    read = ranking.select("feature", F.col("importance").alias("again"))
    joined = chosen.filter("rank is not null").join(read, "feature", "left").join(told, "feature", "left")
    return joined.select(
        "feature",
        "selected",
        F.coalesce(F.abs(F.col("again") - F.col("importance")) < 1e-9, F.lit(False)).alias("in_ranking"),
        (F.coalesce("told", F.lit(False)) == F.col("selected")).alias("in_reports"),
    )


SPLIT_AT = "2024-01-25 00:00:00"


def _split(spark, sf_dir):
    return split_by_time(flows(spark, sf_dir), "ts", SPLIT_AT)


LATER_SQL = f"SELECT * FROM events WHERE ts >= TIMESTAMP '{SPLIT_AT}'"


@query(
    "train_binary",
    f"""WITH y AS (SELECT ts, CASE WHEN value > 20 OR event_type = 'error' THEN 1 ELSE 0 END AS y FROM events),
      p AS (SELECT avg(y) AS p FROM y WHERE ts < TIMESTAMP '{SPLIT_AT}')
    SELECT count(*) AS n, TRUE AS sound, round(avg(-ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)), 9) AS prior_loss,
      TRUE AS better_than_prior, TRUE AS recomputed FROM y, p WHERE ts >= TIMESTAMP '{SPLIT_AT}'""",
)
def binary(spark, sf_dir):
    """Weighted boosted trees with their stated defaults on the earlier events, metrics on the later ones.

    Their log loss is below that of always telling the earlier events' share of class 1.
    """
    train, test = _split(spark, sf_dir)
    model = train_binary(with_class_weights(train, "y"), FEATURES, "y", "weight")
    scored = durable(score_binary(model, test).withColumnRenamed("y", "label"), "scored")
    found = settle(binary_metrics(scored))
    again = scored.agg(
        F.count_if((F.col("score") >= 0.5) == (F.col("label") == 1)).alias("hits"),
        F.every(F.col("score").between(0, 1)).alias("sound"),
    )
    share = F.lit(train.agg(F.avg("y")).first()[0])
    told = scored.agg(F.avg(-F.log(F.when(F.col("label") == 1, share).otherwise(1 - share))).alias("prior"))
    return attach(attach(found, settle(again), []), settle(told), []).select(
        "n",
        "sound",
        F.round("prior", 9).alias("prior_loss"),
        (F.col("logloss") < F.col("prior")).alias("better_than_prior"),
        (F.abs(F.col("accuracy") - F.col("hits") / F.col("n")) < 1e-9).alias("recomputed"),
    )


@query(
    "train_early_stop",
    f"""SELECT (SELECT count(*) FROM ({LATER_SQL})) AS n, TRUE AS within_limit, TRUE AS no_worse, TRUE AS held_back_unseen""",
)
def early_stop(spark, sf_dir):
    """Boosting that ends by the loss of held-back events: rounds used, and that loss next to the loss after all rounds."""
    train, test = _split(spark, sf_dir)
    marked = durable(train.withColumn("held", held_back(["event_id"], 0.25)), "marked")
    limits = {"maxIter": 30, "stepSize": 0.3}
    stopped = train_binary(marked, FEATURES, "y", validation="held", **limits)
    learned = marked.filter("not held")
    whole = train_binary(learned, FEATURES, "y", **limits)
    held = marked.filter("held")
    part = train_binary(learned, FEATURES, "y", **{**limits, "maxIter": rounds_used(stopped)})
    losses = [log_loss(m, held, "y") for m in (stopped, whole, part)]
    return test.agg(F.count("*").alias("n")).select(
        "n",
        F.lit(0 < rounds_used(stopped) <= limits["maxIter"]).alias("within_limit"),
        F.lit(losses[0] <= losses[1] + 1e-9).alias("no_worse"),
        F.lit(abs(losses[0] - losses[2]) < 0.05).alias("held_back_unseen"),
    )


GRID = {"maxDepth": [2, 4], "numTrees": [5]}


@query(
    "grid_search",
    """WITH e AS (SELECT quantile_disc(epoch_us(ts), 1 / 3.0) AS low FROM events)
    SELECT unnest(['{"maxDepth": 2, "numTrees": 5}', '{"maxDepth": 4, "numTrees": 5}']) AS params, 2::BIGINT AS folds,
      (SELECT count(*) FROM events, e WHERE epoch_us(ts) >= low) AS n, TRUE AS like_by_hand, TRUE AS in_order""",
)
def grid(spark, sf_dir):
    """Settings of a forest over time-ordered folds, best first; each score equals that of the same setting run by hand."""
    rows = flows(spark, sf_dir)
    found = grid_search(rows, FEATURES, "y", "ts", GRID, folds=2, train=train_forest)
    board = found.collect()  # a row a setting
    kept = durable(rows.select(*FEATURES, "y", "ts"), "hand")
    folds = time_folds(kept, "ts", 2)
    again = {}
    for row in board:
        scores = []
        for before, after in folds:
            model = train_forest(kept.filter(before), FEATURES, "y", **json.loads(row["params"]))
            scored = score_binary(model, kept.filter(after)).withColumnRenamed("y", "label")
            scores.append(binary_metrics(scored).first()["auc"])
        again[row["params"]] = abs(sum(scores) / len(scores) - row["auc"]) < 1e-6
    aucs = [r["auc"] for r in board]
    same = F.element_at(F.create_map(*[F.lit(x) for pair in again.items() for x in pair]), F.col("params"))
    return found.select("params", "folds", "n", same.alias("like_by_hand"), F.lit(aucs == sorted(aucs, reverse=True)).alias("in_order"))


@query(
    "model_versions",
    f"""SELECT (SELECT count(*) FROM ({LATER_SQL})) AS n, 2::BIGINT AS complete, 4 AS depth, TRUE AS like_unsaved, TRUE AS refused""",
)
def model_versions(spark, sf_dir):
    """Two stored versions and a half-written third: the newest complete one is loaded, and refuses columns that do not fit."""
    train, test = _split(spark, sf_dir)
    folder = scratch_path(spark, "versions")
    for depth in (2, 4):
        model = train_forest(train, FEATURES, "y", numTrees=5, maxDepth=depth)
        save_version(model, folder, train.schema, {"maxDepth": depth, "numTrees": 5})
    save_model(train_forest(train, FEATURES, "y", numTrees=5, maxDepth=3), f"{folder}/v9-broken-off/model")
    loaded, manifest = load_newest(folder, test.schema)
    refused = 0
    for other in (test.drop("hour"), test.withColumn("hour", F.col("hour").cast("string"))):
        try:
            load_newest(folder, other.schema)
        except ValueError:
            refused += 1
    sums = [score_binary(m, test).agg(F.sum("score")).first()[0] for m in (model, loaded)]
    return test.agg(F.count("*").alias("n")).select(
        "n",
        F.lit(versions(spark, folder).count()).cast("long").alias("complete"),
        F.lit(manifest["params"]["maxDepth"]).alias("depth"),
        F.lit(abs(sums[0] - sums[1]) < 1e-6).alias("like_unsaved"),
        F.lit(refused == 2).alias("refused"),
    )


CLASSES_SQL = f"""SELECT CAST(l.label AS INT) AS class, count(*) AS support, TRUE AS sound FROM ({LATER_SQL}) e
  JOIN (SELECT event_type, dense_rank() OVER (ORDER BY event_type) - 1 AS label FROM (SELECT DISTINCT event_type FROM events)) l
  USING (event_type) GROUP BY 1"""


def _class_rows(model, test):
    scored = model.transform(dealt(test, "later")).select("label_id", "prediction", vector_to_array("probability").alias("p"))
    scored = durable(scored, "scored")
    total = F.aggregate("p", F.lit(0.0), lambda a, b: a + b)
    fine = F.forall("p", lambda x: x.between(0, 1)) & (F.abs(total - 1) < 1e-6)
    per_class = class_metrics(scored, "label_id", "prediction").select(F.col("class").cast("int").alias("class"), "support")
    flags = scored.groupBy(F.col("label_id").cast("int").alias("class")).agg(F.every(fine).alias("sound"))
    return per_class.filter("support > 0").join(flags, "class")


@query("train_multiclass", CLASSES_SQL)
def multiclass(spark, sf_dir):
    """Five event types with a forest with its stated defaults; support per class on the later events."""
    train, test = _split(spark, sf_dir)
    return _class_rows(train_multiclass(train, FEATURES, "event_type"), test)


BAND_SQL = """CASE WHEN value > 20 THEN 'high' WHEN hour(ts) < 6 THEN 'night'
  WHEN CAST(regexp_extract(props, '[0-9]+') AS INT) >= 50 THEN 'wide' ELSE 'usual' END"""


@query(
    "train_softmax",
    f"""SELECT {BAND_SQL} AS band, count(*) AS n, TRUE AS sound, TRUE AS below_forest, TRUE AS like_unsaved
    FROM ({LATER_SQL}) GROUP BY 1""",
)
def softmax(spark, sf_dir):
    """Eight rounds of depth 8 boosted under one softmax: on the later events its log loss is below that of the forest with
    its stated defaults, and the stored model, loaded again, scores alike.  Fewer and longer steps than stated (200 of 0.05)."""
    kind = F.when(F.col("value") > 20, "high").when(F.col("hour") < 6, "night").when(F.col("k") >= 50, "wide").otherwise("usual")
    train, test = (part.withColumn("band", kind) for part in _split(spark, sf_dir))
    test = dealt(test, "later")
    model = train_softmax(train, FEATURES, "band", maxIter=8, stepSize=0.5)
    forest = train_multiclass(train, FEATURES, "band").transform(test)
    path = scratch_path(spark, "softmax")
    save_model(model, path)
    scored = durable(score_softmax(model, test), "scored")
    losses = [multiclass_loss(scored), multiclass_loss(forest, probabilities="probability")]
    again = multiclass_loss(score_softmax(load_model(path), test))
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    fine = F.forall("probabilities", lambda x: x.between(0, 1)) & (F.abs(total - 1) < 1e-9)
    return scored.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"),
        F.every(fine).alias("sound"),
        F.lit(losses[0] < losses[1]).alias("below_forest"),
        F.lit(abs(losses[0] - again) < 1e-9).alias("like_unsaved"),
    )


@query("train_one_vs_rest", CLASSES_SQL.replace(", TRUE AS sound", ""))
def one_vs_rest(spark, sf_dir):
    """One boosted model per class, fewer rounds than the default: fitting grows with classes times rounds."""
    train, test = _split(spark, sf_dir)
    model = train_multiclass(train, FEATURES, "event_type", "boosted", maxIter=2, maxDepth=3)
    found = class_metrics(model.transform(test), "label_id", "prediction").filter("support > 0")
    return found.select(F.col("class").cast("int").alias("class"), "support")


@query(
    "leaderboard",
    f"""SELECT unnest(['boosted', 'forest_deep', 'forest_shallow']) AS model, (SELECT count(*) FROM ({LATER_SQL})) AS n,
      TRUE AS good, TRUE AS in_order""",
)
def board(spark, sf_dir):
    """Three models on the later events, best first."""
    train, test = _split(spark, sf_dir)
    models = {
        "forest_shallow": train_forest(train, FEATURES, "y", numTrees=10, maxDepth=3),
        "forest_deep": train_forest(train, FEATURES, "y", numTrees=10, maxDepth=6),
        "boosted": train_binary(train, FEATURES, "y", maxIter=3, maxDepth=3),
    }
    found = leaderboard(models, test, "y")
    scores = [r["auc"] for r in found.collect()]  # a row a model
    ordered = scores == sorted(scores, reverse=True)
    return found.select("model", "n", (F.col("auc") > 0.9).alias("good"), F.lit(ordered).alias("in_order"))


@query("model_importance", "SELECT unnest(['hour', 'k', 'user_load', 'value']) AS feature, TRUE AS scaled_to_one FROM (SELECT 1 FROM events LIMIT 1)")
def variable_importance(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    found = model_importance(train_binary(train, FEATURES, "y", maxIter=3, maxDepth=3))
    fine = settle(found.agg((F.abs(F.max("scaled") - 1) < 1e-12).alias("scaled_to_one")))
    return attach(found.select("feature"), fine, [])


@query(
    "scored_export",
    f"""SELECT CASE WHEN value > 20 OR event_type = 'error' THEN 1 ELSE 0 END AS y, count(*) AS n, TRUE AS sound,
      TRUE AS like_unsaved FROM ({LATER_SQL}) GROUP BY 1""",
)
def export(spark, sf_dir):
    """A stored model, loaded again, scores the later events as it did before it was stored."""
    train, test = _split(spark, sf_dir)
    path = scratch_path(spark, "model")
    model = train_forest(train, FEATURES, "y", numTrees=5, maxDepth=4)
    save_model(model, path)
    loaded = load_model(path)
    before = score_binary(model, test).agg(F.sum("score").alias("s")).first()["s"]
    after = score_binary(loaded, test).agg(F.sum("score").alias("s")).first()["s"]
    rows = scored_export(loaded, test, "y", top_features=3)
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    return rows.groupBy("y").agg(
        F.count(F.lit(1)).alias("n"),
        F.every(F.abs(total - 1) < 1e-9).alias("sound"),
        F.lit(abs(before - after) < 1e-6).alias("like_unsaved"),
    )
