"""Streaming queries, run to the end of the available input."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.functions.columns import epoch_seconds
from graniteflow.operators import regress
from graniteflow.plans.catalog import query
from graniteflow.plans.sqltools import sql_gram, sql_solve
from graniteflow.plans.views import TWEETS, tweets, with_sql
from graniteflow.session import scratch_path
from graniteflow.sources.writers import load_model, save_model
from graniteflow.streaming import streams


def _events(t):
    return streams.file_stream(t.spark, t.folder, t.events.schema, "events.parquet")


@query("hourly_counts_stream", """
SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour_start, event_type, count(*) AS n FROM events GROUP BY ALL""")
def hourly_counts_stream(t):
    """All hours as they stand when the input ends, the open ones too."""
    counts = streams.hourly_counts(_events(t), "ts", "event_type")
    out = streams.latest_totals(counts, ["hour_start", "event_type"], "hourly")
    return out.select(epoch_seconds("hour_start").alias("hour_start"), "event_type", "n")


@query("source_stats_stream", with_sql(TWEETS, """
SELECT tag, count(*) AS n, round(avg(followers), 6) AS mean_followers, round(avg(retweets), 6) AS mean_retweets FROM tweets GROUP BY 1"""))
def source_stats_stream(t):
    rows = _events(t).select(
        F.col("event_type").alias("tag"), F.get_json_object("props", "$.k").cast("bigint").alias("followers"),
        F.floor("value").alias("retweets"),
    )
    out = streams.latest_totals(streams.running_source_stats(rows, "tag", ["followers", "retweets"]), ["tag"], "sources")
    return out.select("tag", "n", F.round("mean_followers", 6).alias("mean_followers"), F.round("mean_retweets", 6).alias("mean_retweets"))


STREAM_X = ["hour", "followers"]


def _features(rows):
    return rows.select(
        "event_id", ((epoch_seconds("ts") % 86400) / 86400.0).alias("hour"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("followers"), "value",
    )


@query("score_stream", with_sql(TWEETS, "f AS (SELECT event_id, (epoch % 86400)/86400.0 AS hour, followers/100.0 AS followers, value FROM tweets)",
                                sql_gram("gram", "f", STREAM_X, "value"), *sql_solve("sol", "gram", 3),
                                "SELECT event_id, round(b_0 + b_1*hour + b_2*followers, 6) AS prediction FROM f CROSS JOIN sol"))
def score_stream(t):
    fitted = regress.ols(_features(t.events), STREAM_X, "value")
    model = load_model(save_model(fitted, scratch_path(t.spark, "model")))
    scored = streams.score(_events(t), _features, model).select("event_id", "prediction")
    return streams.append_to_table(scored, "scores").select("event_id", F.round("prediction", 6).alias("prediction"))
