"""Classification and grouping of a day's titles."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.functions import keywords, text
from headwater.session import settled

THRESHOLD = 0.4


def classify(articles: DataFrame, interest: list[str], exclude: list[str], order: str = "pos") -> DataFrame:
    """verdict and reason of each article. A row with its link that is earlier by ``order`` makes one a repeat, if that has a title."""
    usable = (F.coalesce(F.trim("url"), F.lit("")) != "") & (text.strip(F.col("title")) != "")
    nth = F.row_number().over(Window.partitionBy("kst_date", "url", usable).orderBy(order))
    bad, good = keywords.first_of(F.col("title"), exclude), keywords.first_of(F.col("title"), interest)
    reason = F.when(F.coalesce(F.trim("url"), F.lit("")) == "", "no_url").when(text.strip(F.col("title")) == "", "no_title").when(F.col("nth") > 1, "repeated_url").when(F.col("bad").isNotNull(), F.concat(F.lit("exclude:"), "bad")).when(F.col("good").isNull(), "no_interest").otherwise(F.concat(F.lit("interest:"), "good"))
    out = articles.withColumn("nth", nth).withColumn("bad", bad).withColumn("good", good).withColumn("reason", reason)
    return out.withColumn("verdict", F.when(F.col("reason").startswith("interest:"), "kept").otherwise("dropped")).drop("nth", "bad", "good")


def in_store_order(articles: DataFrame, day: str = "kst_date") -> DataFrame:
    """``pos`` anew: the place in the day by time seen and link, from 0. Groups depend on this order."""
    w = Window.partitionBy(day).orderBy("seen_ts", "url", "pos")
    return articles.withColumn("pos", F.row_number().over(w).cast("long") - 1)


def collector_order(articles: DataFrame, day: str = "kst_date") -> DataFrame:
    """``place`` of a day's articles as the collector lists them: latest first, then by link."""
    return articles.withColumn("place", F.row_number().over(Window.partitionBy(day).orderBy(F.desc("seen_ts"), "url", "pos")))


def jaccard_pairs(titles: DataFrame, threshold: float = THRESHOLD, day: str = "kst_date") -> DataFrame:
    """Pairs of a day's titles with their similarity, from rows of day, pos and tokens.

    A prefix of each title's rarest tokens finds the pairs: two titles that share enough tokens share one of
    those, so a token that all titles have joins only titles made of such tokens. At the first token that both have, in the order of rarity,
    what is left of either must be enough for the rest; pairs for which it isn't at any of their tokens are not looked at.
    """
    rows = titles.select(day, "pos", "tokens", F.size("tokens").alias("n"))
    tokens = rows.select(day, "pos", "n", F.explode("tokens").alias("t"))
    frequency = tokens.groupBy(day, "t").agg(F.count("*").alias("df"))
    ranked = tokens.join(frequency, [day, "t"]).withColumn("r", F.row_number().over(Window.partitionBy(day, "pos").orderBy("df", "t")))
    prefix = ranked.where(F.col("r") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).select(day, "pos", "t", "n", "r")
    a, b = prefix.alias("a"), prefix.alias("b")
    near = (F.col("a.pos") < F.col("b.pos")) & (F.col("a.n") >= F.col("b.n") * threshold - 1e-9) & (F.col("b.n") >= F.col("a.n") * threshold - 1e-9)
    near = near & (F.least(F.col("a.n") - F.col("a.r"), F.col("b.n") - F.col("b.r")) + 1 >= (F.col("a.n") + F.col("b.n")) * (threshold / (1 + threshold)) - 1e-9)
    pairs = a.join(b, (F.col(f"a.{day}") == F.col(f"b.{day}")) & (F.col("a.t") == F.col("b.t")) & near).select(F.col(f"a.{day}").alias(day), F.col("a.pos").alias("pos_a"), F.col("b.pos").alias("pos_b")).distinct()
    sets = rows.select(day, "pos", "tokens")
    both = pairs.join(sets.withColumnsRenamed({"pos": "pos_a", "tokens": "ta"}), [day, "pos_a"]).join(sets.withColumnsRenamed({"pos": "pos_b", "tokens": "tb"}), [day, "pos_b"])
    return both.withColumn("similarity", text.jaccard(F.col("ta"), F.col("tb"))).where(F.col("similarity") >= threshold - 1e-12).select(day, "pos_a", "pos_b", "similarity")


def with_lead(titles: DataFrame, day: str = "kst_date") -> DataFrame:
    """``lead``: the first title of the day with the same set of tokens. Copies meet by their set, never in pairs."""
    sets = titles.withColumn("tokens", F.array_sort("tokens"))
    firsts = sets.groupBy(day, "tokens").agg(F.min("pos").alias("lead"))
    return sets.join(firsts, [day, "tokens"])


def greedy_groups(titles: DataFrame, threshold: float = THRESHOLD, day: str = "kst_date") -> DataFrame:
    """The group of each title: day, pos and group_id of ``led_groups``."""
    return led_groups(titles, threshold, day).select(day, "pos", "group_id")


def led_groups(titles: DataFrame, threshold: float = THRESHOLD, day: str = "kst_date") -> DataFrame:
    """Each title, in order, joins the group with the most similar member so far, the earliest of equal ones, or opens one. Also its ``lead``.

    A title with the tokens of an earlier one joins that one's group, as nothing is more similar, so only the
    first of each set takes part. The pairs that reach the threshold are found by the distributed join; a day's own order is
    then followed over those pairs alone, in one task a day.
    """
    led = with_lead(titles, day)
    firsts = led.where("pos = lead")
    pairs = jaccard_pairs(firsts, threshold, day).select(day, F.col("pos_b").alias("pos"), "pos_a", "similarity")
    rows = firsts.select(day, "pos").join(pairs, [day, "pos"], "left")

    def follow(own: pd.DataFrame) -> pd.DataFrame:
        group: dict[int, int] = {}
        opened = 0
        for pos, near in own.sort_values(["pos", "pos_a"]).groupby("pos", sort=True):
            best, score = None, -1.0
            scores: dict[int, float] = {}
            for p, s in zip(near["pos_a"], near["similarity"], strict=True):
                if p == p:
                    g = group[int(p)]
                    scores[g] = max(scores.get(g, 0.0), s)
            for g in sorted(scores):
                if scores[g] > score:
                    best, score = g, scores[g]
            group[int(pos)] = opened if best is None else best
            opened += best is None
        return pd.DataFrame({day: own[day].iloc[0], "lead": list(group), "group_id": list(group.values())})

    kind = dict(titles.dtypes)[day]
    groups = rows.groupBy(day).applyInPandas(follow, f"{day} {kind}, lead long, group_id long")
    return led.select(day, "pos", "lead").join(groups, [day, "lead"])


def medoids(groups: DataFrame, titles: DataFrame, day: str = "kst_date") -> DataFrame:
    """The member of each group that is most similar to the others together; the first of equal ones.

    Sums are over the group's distinct sets, each weighted by its copies; sets that share no token add nothing and aren't met.
    """
    return led_medoids(with_lead(groups.join(titles.select(day, "pos", "tokens"), [day, "pos"]), day), day)


def led_medoids(led: DataFrame, day: str = "kst_date") -> DataFrame:
    """The same from titles with group, tokens and lead."""
    sets = led.groupBy(day, "group_id", "lead").agg(F.first("tokens").alias("tokens"), F.count("*").alias("copies"))
    size = sets.select(day, "group_id", "lead", "copies", F.size("tokens").alias("n"), F.explode("tokens").alias("t"))
    other = size.select(day, "group_id", "t", F.col("lead").alias("lead_b"), F.col("copies").alias("copies_b"), F.col("n").alias("n_b"))
    shared = size.join(other, [day, "group_id", "t"]).groupBy(day, "group_id", "lead", "lead_b").agg(F.count("*").alias("both"), F.first("n").alias("n"), F.first("n_b").alias("n_b"), F.first("copies_b").alias("copies_b"))
    similarity = F.col("both") / (F.col("n") + F.col("n_b") - F.col("both"))
    # a title isn't compared with itself, but with its own copies
    weight = F.col("copies_b") - (F.col("lead") == F.col("lead_b")).cast("long")
    sums = shared.groupBy(day, "group_id", "lead").agg(F.round(F.sum(similarity * weight), 9).alias("score"))
    return sums.groupBy(day, "group_id").agg(F.max_by("lead", F.struct("score", -F.col("lead"))).alias("medoid"))


def group_summary(groups: DataFrame, articles: DataFrame, regulation: list[str], tool: list[str], day: str = "kst_date") -> DataFrame:
    """Size, distinct outlets and kind of each group, with its place in the day's order."""
    return summed(groups.join(articles.select(day, "pos", "title", "domain"), [day, "pos"]), regulation, tool, day)


def summed(rows: DataFrame, regulation: list[str], tool: list[str], day: str = "kst_date", *more: Column) -> DataFrame:
    """Groups from titles with their group, by one aggregation, with further sums if wanted.

    ``domain_count`` may be 0 and orders the groups; ``told_by`` is what sentences say, the size where no outlet is known.
    """
    agg = rows.groupBy(day, "group_id").agg(
        F.count("*").alias("article_count"), F.count_distinct(F.nullif("domain", F.lit(""))).alias("domain_count"), F.sum(keywords.hits(F.col("title"), regulation)).alias("reg"), F.sum(keywords.hits(F.col("title"), tool)).alias("tool"), F.min("pos").alias("first_pos"), *more
    )
    place = F.row_number().over(Window.partitionBy(day).orderBy(F.desc("domain_count"), F.desc("article_count"), "first_pos"))
    told = F.when(F.col("domain_count") > 0, F.col("domain_count")).otherwise(F.col("article_count"))
    return agg.withColumn("kind", kind_of(F.col("reg"), F.col("tool"))).withColumn("told_by", told).withColumn("place", place).drop("reg", "tool", "first_pos")


def kind_of(regulation, tool):
    return F.when((regulation > 0) & (regulation >= tool), "policy").when(tool > 0, "tool").otherwise("other")


def shaped_groups(titles: DataFrame, regulation: list[str], tool: list[str], threshold: float = THRESHOLD, day: str = "kst_date") -> DataFrame:
    """Groups of kept titles (day, pos, url, title, domain, tokens): group_id, place, kind, headline and urls in the order of the titles."""
    # written once: titles with all that the groups are made from
    own = settled(led_groups(titles, threshold, day).join(titles.select(day, "pos", "url", "title", "domain", "tokens"), [day, "pos"]))
    lead = led_medoids(own, day).join(own.select(day, "group_id", F.col("pos").alias("medoid"), "title"), [day, "group_id", "medoid"])
    links = F.transform(F.array_sort(F.collect_list(F.struct("pos", "url"))), lambda x: x["url"]).alias("urls")
    out = summed(own, regulation, tool, day, links).join(lead, [day, "group_id"])
    return out.select(day, "group_id", "place", "kind", "article_count", "domain_count", "medoid", text.headline_sentence(F.col("title"), F.col("told_by")).alias("headline"), "urls")


def brief_selection(summary: DataFrame, most: int = 5, day: str = "kst_date") -> DataFrame:
    """The lead and the groups within the budget, by section."""
    section = F.when(F.col("place") == 1, "lead").when(F.col("kind") == "policy", "policy").otherwise("general")
    return summary.where(F.col("place") <= most).withColumn("section", section)
