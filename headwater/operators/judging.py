"""Days judged by rules or by a model's landed answers, stored as a whole, and judged again only where something has changed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headwater.functions import text
from headwater.operators import decisions, grouping
from headwater.session import settled
from headwater.sinks.versions import DAY, DayTables

SCHEMAS = {
    "runs": "backend string, requested_backend string, fallback_reason string, saved_at timestamp",
    "decisions": "position int, verdict string, url string, reason string",
    "groups": "group_id int, headline string, kind string",
    "group_urls": "group_id int, position int, url string",
}
#: Reasons that need no judgement; a model isn't asked about such rows unless the caller says so.
SORTED_OUT = ("no_url", "no_title", "repeated_url")


@dataclass
class Words:
    interest: list[str]
    exclude: list[str]
    regulation: list[str]
    tool: list[str]
    stopwords: list[str] = field(default_factory=list)
    threshold: float = grouping.THRESHOLD


def tables(spark: SparkSession, folder: str) -> DayTables:
    return DayTables(spark, folder, SCHEMAS)


def backends(days: DataFrame, candidates: DataFrame, spoken: DataFrame, wanted: str) -> DataFrame:
    """For each day who decides and, where it isn't who was asked for, why.

    A model decides a day if one of its candidates is spoken of, or if there is none to ask about. ``days`` has the day and
    ``answered``, whether an answer has landed.
    """
    asked = wanted.strip().lower()
    told = days.join(candidates.select(DAY).distinct().withColumn("asked", F.lit(True)), DAY, "left").join(spoken.select(DAY).distinct().withColumn("spoken", F.lit(True)), DAY, "left")
    model = F.lit(asked == "llm") & (F.col("spoken").isNotNull() | F.col("asked").isNull())
    why = F.when(model | F.lit(asked == "rules"), F.lit(None)).when(F.lit(asked != "llm"), F.lit(f"unknown backend {asked}")).when(F.col("answered"), "the answer is of no use").otherwise("no answer has landed")
    return told.select(DAY, F.when(model, "llm").otherwise("rules").alias("backend"), F.lit(asked).alias("requested_backend"), why.cast("string").alias("fallback_reason"))


def judged(articles: DataFrame, words: Words, wanted: str = "rules", answers: DataFrame | None = None, days: DataFrame | None = None, arrival: str = "pos", unasked: Sequence[str] = SORTED_OUT) -> dict[str, DataFrame]:
    """The four tables of the days of ``articles`` (day, pos in order, url, title, domain, seen_ts), and of ``days`` without any.

    ``answers``: day and body of a model's answer for the day's candidates, numbered from 1 in the articles' order. With ``wanted`` llm these
    decide the days they are usable for; all other days go to the rules, and ``runs`` tells which did and why. Of rows with one link the first by
    ``arrival`` counts, whatever the order of the day. Rows put aside for a reason in ``unasked`` are no candidates and have no number.
    """
    spark = articles.sparkSession
    ruled = settled(grouping.classify(articles, words.interest, words.exclude, arrival))
    order = Window.partitionBy(DAY).orderBy("pos")
    candidates = settled(ruled.where(~F.col("reason").isin(*unasked)).withColumn("n", F.row_number().over(order)))
    answers = spark.createDataFrame([], f"{DAY} date, body string") if answers is None or wanted.strip().lower() != "llm" else answers
    model = settled(decisions.model_verdicts(answers, candidates.select(DAY, "n", "pos", "url", "title", "domain"), DAY))
    every = articles.select(DAY).distinct() if days is None else articles.select(DAY).union(days.select(DAY)).distinct()
    runs = settled(backends(every.join(answers.select(DAY).distinct().withColumn("answered", F.lit(True)), DAY, "left"), candidates, model, wanted))
    by = runs.select(DAY, "backend")
    # a model's day: what was sorted out comes before what the model drops
    own = ruled.join(by, DAY).join(model.select(DAY, "pos", F.col("verdict").alias("said"), F.col("reason").alias("why")), [DAY, "pos"], "left")
    by_model = (F.col("backend") == "llm") & F.col("said").isNotNull()
    own = own.withColumn("last", by_model.cast("int")).withColumn("verdict", F.when(by_model, F.col("said")).otherwise(F.col("verdict"))).withColumn("reason", F.when(by_model, F.col("why")).otherwise(F.col("reason")))
    place = F.row_number().over(Window.partitionBy(DAY).orderBy(F.col("verdict") != "kept", "last", "pos")) - 1
    # a link is stored trimmed, and a row without one as an empty text
    decided = settled(own.withColumn("position", place).withColumn("url", text.strip(F.col("url"))).select(DAY, "position", "verdict", "url", "reason", "pos", "title", "domain", "backend", *(["seen_ts"] if "seen_ts" in articles.columns else [])))
    kept = decided.where("backend = 'rules' and verdict = 'kept'").withColumn("tokens", text.tokens(F.col("title"), words.stopwords))
    shaped = grouping.shaped_groups(settled(kept.select(DAY, "pos", "url", "title", "domain", "tokens")), words.regulation, words.tool, words.threshold)
    groups = shaped.select(DAY, (F.col("place") - 1).alias("group_id"), "kind", "headline", "urls")
    if wanted.strip().lower() == "llm":
        groups = groups.union(decisions.model_groups(answers, model, words.regulation, words.tool, words.stopwords, DAY).select(DAY, "group_id", "kind", "headline", "urls"))
    heads, links = decisions.flat_groups(settled(groups), DAY)
    return {"runs": runs.withColumn("saved_at", F.current_timestamp()), "decisions": decided.select(DAY, "position", "verdict", "url", "reason"), "groups": heads, "group_urls": links}


def states(store: DayTables, handled: DataFrame, days: DataFrame, wanted: str = "rules", force: bool = False) -> DataFrame:
    """For each of ``days`` whether what is stored still holds: ``reason`` is empty, or forced, none, backend, count or links.

    It holds if the same backend was asked for, whoever decided in the end, and the links are the same, each as often. A day that has
    no articles any more has another count.
    """
    state = store.days()
    runs = store.read("runs", state=state).select(DAY, F.lower(text.strip(F.coalesce("requested_backend", "backend"))).alias("asked"))
    a = store.read("decisions", state=state).join(days, DAY, "left_semi").groupBy(DAY, F.coalesce("url", F.lit("")).alias("url")).agg(F.count("*").alias("s"))
    b = handled.groupBy(DAY, text.strip(F.col("url")).alias("url")).agg(F.count("*").alias("h"))
    both = a.join(b, [DAY, "url"], "full").na.fill(0, ["s", "h"]).groupBy(DAY).agg(F.sum("s").alias("n_stored"), F.sum("h").alias("n_handled"), F.count_if(F.col("s") != F.col("h")).alias("differ"))
    rows = days.select(DAY).distinct().join(runs, DAY, "left").join(both, DAY, "left").na.fill(0, ["n_stored", "n_handled", "differ"])
    reason = F.when(F.lit(force), "forced").when(F.col("asked").isNull(), "none").when(F.col("asked") != wanted.strip().lower(), "backend").when(F.col("n_stored") != F.col("n_handled"), "count").when(F.col("differ") > 0, "links").otherwise("")
    return rows.select(DAY, "n_stored", "n_handled", reason.alias("reason")).withColumn("reused", F.col("reason") == "")


def judge_days(store: DayTables, articles: DataFrame, days: list[date], words: Words, wanted: str = "rules", answers: DataFrame | None = None, force: bool = False, arrival: str = "pos", unasked: Sequence[str] = SORTED_OUT) -> DataFrame:
    """Judges those of ``days`` that need it (see ``judged``), puts their four tables in place in one step, and returns the states that were found."""
    spark = articles.sparkSession
    asked = spark.createDataFrame([(d,) for d in days], f"{DAY} date")
    rows = articles.join(F.broadcast(asked), DAY, "left_semi")
    found = settled(states(store, rows.select(DAY, "url"), asked, wanted, force))
    again = [r[DAY] for r in found.where("not reused").select(DAY).collect()]
    if again:
        open_days = found.where("not reused").select(DAY)
        store.replace(again, judged(rows.join(open_days, DAY, "left_semi"), words, wanted, answers, open_days, arrival, unasked))
    return found


def stored_groups(store: DayTables, first: date | None = None, last: date | None = None) -> DataFrame:
    """Groups as they were decided: day, group_id, headline, kind and urls in stored order, both tables of one state."""
    state = store.days()
    return decisions.regrouped(store.read("groups", first, last, state), store.read("group_urls", first, last, state), DAY)
