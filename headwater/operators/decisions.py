"""A day's decisions: from a language model's answer, stored, nested again, and reused while nothing has changed."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.functions import keywords, text
from headwater.operators import grouping
from headwater.session import settled

KINDS = ("tool", "policy", "other")
#: Both names of each field of an answer, and what is said where it gives no reason.
NAMES = {"decisions": ("판단", "decisions"), "index": ("번호", "index"), "keep": ("채택", "keep"), "reason": ("이유", "reason"), "groups": ("묶음", "groups"), "indexes": ("번호들", "indexes"), "kind": ("종류", "kind"), "headline": ("제목", "headline")}
REASONS = {"kept": "모델이 AI 소식으로 봤다", "dropped": "모델이 AI 소식이 아니라고 봤다", "unsaid": "모델이 따로 언급하지 않아 뺐다"}


def _json(body: str):
    """The JSON value that a body is as a whole, maybe fenced, or else from its first brace to its last; None if neither is one."""
    body = body.strip()
    if body.startswith("```"):
        body = re.sub(r"\s*```$", "", re.sub(r"^```[a-zA-Z]*\s*", "", body))
    first, last = body.find("{"), body.rfind("}")
    for part in (body, body[first : last + 1] if 0 <= first < last else ""):
        try:
            return json.loads(part)
        except ValueError:
            continue
    return None


def _number(value) -> int | None:
    try:
        found = int(value)
    except (TypeError, ValueError, OverflowError):
        return None
    return found if abs(found) < 2**31 else None


def _read(body: str | None) -> dict | None:
    """One answer's decisions and groups, or None if it has no list of decisions."""
    found = _json(body or "")
    if not isinstance(found, dict):
        return None
    # the first name that holds something counts; for numbers and verdicts, the first that is there at all
    some = lambda item, field: item.get(NAMES[field][0]) or item.get(NAMES[field][1])
    there = lambda item, field: item.get(NAMES[field][0], item.get(NAMES[field][1]))
    listed = lambda x: [y for y in x if isinstance(y, dict)] if isinstance(x, list) else []
    decisions = [{"n": _number(there(x, "index")), "keep": bool(there(x, "keep")), "why": str(some(x, "reason") or "").strip()} for x in listed(some(found, "decisions"))]
    groups = []
    for x in listed(some(found, "groups")):
        ns = some(x, "indexes")
        groups.append({"ns": [_number(i) for i in ns] if isinstance(ns, list) else [], "kind": str(some(x, "kind") or "").strip().lower(), "headline": str(some(x, "headline") or "")})
    return {"decisions": decisions, "groups": groups} if decisions else None


READ = "decisions array<struct<n:int,keep:boolean,why:string>>, groups array<struct<ns:array<int>,kind:string,headline:string>>"


def _read_bodies(bodies: pd.Series) -> pd.DataFrame:
    read = [_read(b) or {"decisions": None, "groups": None} for b in bodies]
    return pd.DataFrame({k: pd.Series([r[k] for r in read], dtype=object) for k in ("decisions", "groups")})


def read_answers(answers: DataFrame, day: str = "kst_date") -> DataFrame:
    """day, decisions (n, keep, why), groups (ns, kind, headline) and whether there is any decision, from rows of day and body.

    A body is JSON as a whole, maybe fenced, or else from its first brace to its last; anything else isn't usable. Of each field
    one of two names counts. Entries of lists that aren't objects are passed over; a number that can't be read is null. There is an answer
    a day, so few rows; they go through Arrow to Python's own JSON reader, whose rules for numbers and truth values are wanted.
    """
    read = answers.select(day, F.pandas_udf(_read_bodies, READ)("body").alias("a"))
    return read.select(day, "a.decisions", "a.groups", F.coalesce(F.size("a.decisions") > 0, F.lit(False)).alias("usable"))


def model_verdicts(answers: DataFrame, candidates: DataFrame, day: str = "kst_date") -> DataFrame:
    """The candidates (day, n from 1, url, title, domain) with verdict, reason and whether the answer spoke of them.

    The last word on a candidate counts; one that isn't spoken of is dropped. Days without a usable answer have no rows: they
    are for the rules.
    """
    read = read_answers(answers, day).where("usable")
    lines = read.select(day, F.posexplode("decisions").alias("at", "d"))
    said = lines.select(day, "d.n", "at", "d.keep", F.nullif("d.why", F.lit("")).alias("why"))
    last = said.where("n is not null").groupBy(day, "n").agg(F.max_by(F.struct("keep", "why"), "at").alias("s"))
    rows = candidates.join(last, [day, "n"], "left")
    # an answer that speaks of no candidate at all is of no use either
    rows = rows.join(rows.where("s is not null").select(day).distinct(), day, "left_semi")
    kept = F.coalesce(F.col("s.keep"), F.lit(False))
    reason = F.coalesce(F.col("s.why"), F.when(kept, REASONS["kept"]).when(F.col("s").isNotNull(), REASONS["dropped"]).otherwise(REASONS["unsaid"]))
    return rows.select(*candidates.columns, F.when(kept, "kept").otherwise("dropped").alias("verdict"), reason.alias("reason"), F.col("s").isNotNull().alias("said"))


def model_groups(answers: DataFrame, verdicts: DataFrame, regulation: list[str], tool: list[str], stopwords: list[str] = (), day: str = "kst_date") -> DataFrame:
    """Groups of the kept candidates: day, group_id, kind, headline and urls.

    A candidate belongs to the first group that names it. An unknown kind is voted on anew, an empty headline made from the first
    title; candidates that no group names are grouped by the rules, after the others.
    """
    kept = settled(verdicts.where("verdict = 'kept'"))
    groups = read_answers(answers, day).where("usable").select(day, F.posexplode("groups").alias("g", "x"))
    named = groups.select(day, "g", "x.kind", text.clean_prose(F.col("x.headline")).alias("headline"), F.posexplode("x.ns").alias("at", "n"))
    own = named.groupBy(day, "n").agg(F.min(F.struct("g", "at", "kind", "headline")).alias("s")).select(day, "n", "s.*").join(kept, [day, "n"])
    rows = own.withColumns({"reg": keywords.hits(F.col("title"), regulation), "tools": keywords.hits(F.col("title"), tool)})
    outlets = F.count_distinct(F.nullif("domain", F.lit("")))
    told = rows.groupBy(day, "g").agg(
        F.first("kind").alias("kind"), F.first("headline").alias("headline"), F.sum("reg").alias("reg"), F.sum("tools").alias("tools"),
        F.when(outlets > 0, outlets).otherwise(F.count("*")).alias("told_by"), F.array_sort(F.collect_list(F.struct("at", "url", "title"))).alias("all"),
    )
    kind = F.when(F.col("kind").isin(*KINDS), F.col("kind")).otherwise(grouping.kind_of(F.col("reg"), F.col("tools")))
    headline = F.when(F.col("headline") != "", F.col("headline")).otherwise(text.headline_sentence(F.get("all", 0)["title"], F.col("told_by")))
    said = told.select(day, F.lit(0).alias("by_rules"), F.col("g").cast("long").alias("at"), kind.alias("kind"), headline.alias("headline"), F.transform("all", lambda x: x["url"]).alias("urls"))
    rest = kept.join(own.select(day, "n"), [day, "n"], "left_anti").withColumn("pos", F.col("n").cast("long")).withColumn("tokens", text.tokens(F.col("title"), stopwords))
    rest = settled(rest)
    ruled = grouping.shaped_groups(rest, regulation, tool, day=day).select(day, F.lit(1).alias("by_rules"), F.col("place").cast("long").alias("at"), "kind", "headline", "urls")
    number = F.row_number().over(Window.partitionBy(day).orderBy("by_rules", "at")) - 1
    return said.union(ruled).select(day, number.alias("group_id"), "kind", "headline", "urls")


def nested(decisions: DataFrame, groups: DataFrame, day: str = "kst_date") -> DataFrame:
    """One row a day, as it is handed on: kept and dropped (arrays of url and reason) and groups (headline, urls, kind), all in stored order."""
    listed = lambda verdict: F.transform(F.array_sort(F.collect_list(F.when(F.col("verdict") == verdict, F.struct("position", "url", "reason")))), lambda x: F.struct(x["url"].alias("url"), x["reason"].alias("reason")))
    days = decisions.groupBy(day).agg(listed("kept").alias("kept"), listed("dropped").alias("dropped"))
    own = groups.groupBy(day).agg(F.transform(F.array_sort(F.collect_list(F.struct("group_id", "headline", "urls", "kind"))), lambda x: F.struct(x["headline"].alias("headline"), x["urls"].alias("urls"), x["kind"].alias("kind"))).alias("groups"))
    return days.join(own, day, "left")


def regrouped(groups: DataFrame, urls: DataFrame, day: str = "kst_date") -> DataFrame:
    """Groups with their links in stored order, from the two flat tables; a group without links keeps an empty list."""
    lists = urls.groupBy(day, "group_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "url"))), lambda x: x["url"]).alias("urls"))
    return groups.join(lists, [day, "group_id"], "left").withColumn("urls", F.coalesce("urls", F.array().cast("array<string>")))


def flat_groups(groups: DataFrame, day: str = "kst_date") -> tuple[DataFrame, DataFrame]:
    """The two tables that ``regrouped`` takes: unknown kinds are other, headlines cleaned, positions from 0."""
    kind = F.lower(text.strip(F.col("kind")))
    heads = groups.select(day, "group_id", text.clean_prose(F.col("headline")).alias("headline"), F.when(kind.isin(*KINDS), kind).otherwise("other").alias("kind"))
    return heads, groups.select(day, "group_id", F.posexplode("urls").alias("position", "url"))


def reuse(stored: DataFrame, handled: DataFrame, wanted: str = "rules", force: bool = False, day: str = "kst_date") -> DataFrame:
    """For each day of ``handled`` (day, url) whether the stored decisions (day, url, backend) still hold, and if not why.

    They hold if the backend asked for is the same and so are the links, each as often: ``reason`` is forced, none (nothing stored), backend,
    count or links, or an empty text where they hold. Days without a row in ``handled`` have no row here; ``judging.states`` has them. Both sides are counted by link first, so no day is gathered in a task.
    """
    a = stored.groupBy(day, F.coalesce("url", F.lit("")).alias("url")).agg(F.count("*").alias("n_stored"), F.max(F.lower(text.strip(F.col("backend")))).alias("backend"))
    b = handled.groupBy(day, text.strip(F.col("url")).alias("url")).agg(F.count("*").alias("n_handled"))
    both = b.join(a, [day, "url"], "full").na.fill(0, ["n_stored", "n_handled"])
    days = both.groupBy(day).agg(F.sum("n_stored").alias("n_stored"), F.sum("n_handled").alias("n_handled"), F.count_if(F.col("n_stored") != F.col("n_handled")).alias("differ"), F.max("backend").alias("backend")).where("n_handled > 0")
    reason = F.when(F.lit(force), "forced").when(F.col("n_stored") == 0, "none").when(F.col("backend") != wanted.strip().lower(), "backend").when(F.col("n_stored") != F.col("n_handled"), "count").when(F.col("differ") > 0, "links").otherwise("")
    return days.select(day, "n_stored", "n_handled", reason.alias("reason")).withColumn("reused", F.col("reason") == "")


def kept_titles(decided: DataFrame, stopwords: list[str] = ()) -> DataFrame:
    """Kept articles in store order, with tokens: what the rules group."""
    return grouping.in_store_order(decided.where("verdict = 'kept'")).withColumn("tokens", text.tokens(F.col("title"), stopwords))
