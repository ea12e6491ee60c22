"""Tables behind the weekly report, and its text."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwater.functions import keywords, text, timewin, urls
from headwater.functions.wording import REPORT

#: Names under which settings list keywords.
LISTS = ("keywords", "keyword_list", "watch_keywords")
NAMES = ("keyword", "name", "label", "term", "key", "word")
LATIN = ("roman", "latin", "ascii", "en", "english", "slug", "chart_label")


def merge_headlines(groups: DataFrame) -> DataFrame:
    """Groups of a week with one headline and kind as one: first day, and links in order without repeats."""
    cleaned = groups.withColumn("headline", text.clean_prose(F.col("headline"))).where("headline <> ''")
    agg = cleaned.groupBy("week", "kind", F.lower("headline").alias("key")).agg(F.min("kst_date").alias("first_date"), F.array_sort(F.collect_list(F.struct("kst_date", "group_id", "headline", "urls"))).alias("all"))
    return agg.select("week", "kind", "first_date", F.get("all", 0)["headline"].alias("headline"), F.array_distinct(F.flatten(F.transform("all", lambda g: g["urls"]))).alias("urls"))


def report_order(merged: DataFrame) -> DataFrame:
    """``line_no`` in a week's list of a kind: by first day, then headline."""
    return merged.withColumn("line_no", F.row_number().over(Window.partitionBy("week", "kind").orderBy("first_date", "headline")))


def group_lines(merged: DataFrame) -> DataFrame:
    """The report's line of each merged group, in its order."""
    link, n = urls.tidy(F.get("urls", 0)), F.size("urls")
    tail = F.when(n == 0, F.lit(REPORT["no_link"])).when(n == 1, text.filled(REPORT["one_link"].replace("{link}", "{0}"), link)).otherwise(text.filled(REPORT["links"].replace("{n}", "{0}").replace("{link}", "{1}"), n, link))
    line = F.concat(F.lit("- "), F.date_format("first_date", "MM-dd"), F.lit(" "), F.col("headline"), F.lit(" ("), tail, F.lit(")"))
    return report_order(merged).select("week", "kind", "line_no", line.alias("line"))


def missing_days(calendar: DataFrame, decided: DataFrame, today: date) -> DataFrame:
    """Days without decisions, and whether they are still to come."""
    out = calendar.join(decided.select("kst_date").distinct(), "kst_date", "left_anti")
    return out.withColumn("state", F.when(F.col("kst_date") > F.lit(today), "upcoming").otherwise("missing"))


def kept_links(decisions: DataFrame) -> DataFrame:
    """Distinct kept links of each week."""
    return decisions.where("verdict = 'kept'").groupBy(F.to_date(F.date_trunc("WEEK", "kst_date")).alias("week")).agg(F.count_distinct("url").alias("n_kept"))


def weekly_volume(decisions: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Kept links of each week against the week before, and the difference.

    ``counted`` has a row (week) for each week in which some keyword was counted. ``last_kept`` is null only where the week before has
    neither decisions nor a counted keyword; with keywords alone it is 0.
    """
    weeks = decisions.groupBy(F.to_date(F.date_trunc("WEEK", "kst_date")).alias("week")).agg(F.count_distinct(F.when(F.col("verdict") == "kept", F.col("url"))).alias("n_kept"))
    before = weeks.select(F.date_add("week", 7).alias("week"), F.col("n_kept").alias("last_kept"))
    if counted is not None:
        others = counted.select(F.date_add("week", 7).alias("week")).distinct().join(before, "week", "left_anti")
        before = before.union(others.withColumn("last_kept", F.lit(0).cast("long")))
    return weeks.join(before, "week", "left").withColumn("diff", F.col("n_kept") - F.col("last_kept"))


def counted_weeks(keyword_days: DataFrame) -> DataFrame:
    """Weeks with at least one article for a keyword, from counts by keyword and day."""
    return keyword_days.where("n > 0").select(F.to_date(F.date_trunc("WEEK", "kst_date")).alias("week")).distinct()


def week_rows(articles: DataFrame, entries: list[dict], start: date, most: int = 5) -> DataFrame:
    """The keyword table of the week from ``start``: this week, last week, delta, note and label, most frequent first.

    Both weeks come from one scan. ``entries``: name and, if known, roman, which labels a chart without Hangul letters.
    """
    week = articles.where(F.col("kst_date").between(F.lit(start - timedelta(days=7)), F.lit(start + timedelta(days=6))))
    this = F.col("kst_date") >= F.lit(start)
    sums = [(F.coalesce(F.sum((keywords.counts(F.col("title"), e["name"]) & this).cast("long")), F.lit(0)), F.coalesce(F.sum((keywords.counts(F.col("title"), e["name"]) & ~this).cast("long")), F.lit(0))) for e in entries]
    counted = week.agg(*[c.alias(f"{side}{i}") for i, pair in enumerate(sums) for side, c in zip("tl", pair, strict=True)])
    rows = [F.struct(F.lit(e["name"]).alias("keyword"), F.lit(e.get("roman") or "").alias("roman"), F.col(f"t{i}").alias("this_week"), F.col(f"l{i}").alias("last_week")) for i, e in enumerate(entries)]
    if not rows:
        return articles.sparkSession.createDataFrame([], "keyword string, roman string, this_week long, last_week long, delta long, delta_text string, note string")
    return shaped_rows(counted.select(F.inline(F.array(*rows))), most)


def shaped_rows(counted: DataFrame, most: int = 5) -> DataFrame:
    """The keyword table from keyword, roman, this_week and last_week."""
    out = counted.where("this_week > 0 or last_week > 0").withColumn("delta", F.col("this_week") - F.col("last_week"))
    note = F.when(F.col("last_week") == 0, "new").when(F.col("this_week") == 0, "gone").otherwise("")
    return out.withColumns({"delta_text": text.delta_text(F.col("delta")), "note": note}).orderBy(F.desc("this_week"), F.desc("last_week"), "keyword").limit(most)


def keyword_entries(config: dict) -> list[dict]:
    """Names and romanised labels from settings: a list of names or objects, or an object of them; repeats go."""
    raw = next((config[k] for k in LISTS if config.get(k)), None)
    if isinstance(raw, dict):
        raw = next((raw[k] for k in ("keywords", "list", "items") if raw.get(k)), list(raw))
    out: dict[str, dict] = {}
    for item in raw if isinstance(raw, list | tuple) else []:
        own = {"keyword": item} if isinstance(item, str) else item if isinstance(item, dict) else {}
        name = next((str(own[k]).strip() for k in NAMES if str(own.get(k) or "").strip()), "")
        roman = next((own[k].strip() for k in LATIN if isinstance(own.get(k), str) and own[k].strip() and own[k].isascii()), None)
        if name:
            out.setdefault(name, {"name": name, "roman": roman})
    return list(out.values())


def particle(word: str, closed: str, open_: str) -> str:
    """The same as ``text.particle`` with the report's letters, for a single word."""
    last = word[-1:].lower()
    jong = (ord(last) - 0xAC00) % 28 if "가" <= last <= "힣" else None
    ends = jong > 0 if jong is not None else last in "013678flmnrsx" if last else False
    liquid = jong == 8 if jong is not None else last in "lr178"
    return closed if ends and not (liquid and closed == "으로") else open_


def volume_sentence(kept: int, last: int | None) -> str:
    if last is None:
        return REPORT["kept_alone"].format(n=kept)
    change = "rose" if kept > last else "fell" if kept < last else "same"
    return REPORT["kept"].format(n=kept, last=last) + REPORT[change].format(n=abs(kept - last))


def top_sentence(rows: list[dict], compare: bool) -> str:
    top = rows[0]
    out = REPORT["top"].format(word=top["keyword"], particle=particle(top["keyword"], "으로", "로"), n=top["this_week"])
    change = "top_rose" if top["delta"] > 0 else "top_fell" if top["delta"] < 0 else "top_same"
    return out + (REPORT[change].format(n=abs(top["delta"])) if compare else "")


def markdown(start: date, rows: list[dict], lines: dict[str, list[str]], kept: int, last_kept: int | None, missing: list[str] = (), upcoming: list[str] = (), comments: list[str] = (), chart: str | None = None, source: str = "") -> str:
    """The report of the week from ``start``, from the few rows of its tables. It doesn't tell when it was made, so equal input gives equal text."""
    compare = last_kept is not None
    out = ["# " + REPORT["title"], "", REPORT["period"].format(first=start.isoformat(), last=(start + timedelta(days=6)).isoformat()), volume_sentence(kept, last_kept)]
    for key, days in (("missing", missing), ("upcoming", upcoming)):
        out += [REPORT[key].format(n=len(days), days=", ".join(days))] if days else []
    for kind, heading, none in (("tool", "tools", "no_tools"), ("policy", "policies", "no_policies")):
        out += ["", "## " + REPORT[heading], "", *(lines.get(kind) or [REPORT[none]])]
    out += ["", "## " + REPORT["keywords"], ""]
    if not rows:
        out.append(REPORT["no_keywords"])
    else:
        cells = [[r["keyword"], str(r["this_week"])] + ([str(r["last_week"]), r["delta_text"]] if compare else []) for r in rows]
        out += [*REPORT["table" if compare else "table_alone"], *("| " + " | ".join(c) + " |" for c in cells), "", top_sentence(rows, compare)]
        for note, key in (("new", "fresh"), ("gone", "gone")):
            words = [r["keyword"] for r in rows if r["note"] == note]
            out += [REPORT[key].format(words=", ".join(words), particle=particle(words[-1], "이다", "다"))] if compare and words else []
    out += ["", f"![]({chart})"] if chart else []
    out += ["", "## " + REPORT["comments"], "", *([REPORT["comments_kept"], "", *comments] if comments else [REPORT["comments_empty"], "", ">", ">"])]
    return "\n".join([*out, "", source, ""])


def human_comments(old: str) -> list[str]:
    """The quoted lines that people wrote into a report's section for them; empty if they wrote none."""
    _, found, rest = ("\n" + (old or "")).partition(f"\n## {REPORT['comments']}\n")
    own = [x.rstrip() for x in rest.split("\n## ", 1)[0].splitlines() if x.lstrip().startswith(">")] if found else []
    while own and own[0].strip() == ">":
        own = own[1:]
    while own and own[-1].strip() == ">":
        own = own[:-1]
    return own


def replaced(old: str | None, new: str, force: bool = False) -> str | None:
    """What to write over a report: the new text with the old one's comments, or None if the old one has other changes and ``force`` isn't set."""
    if not old:
        return new
    own = human_comments(old)
    if own and not human_comments(new):
        empty = "\n".join([REPORT["comments_empty"], "", ">", ">"])
        return new.replace(empty, "\n".join([REPORT["comments_kept"], "", *own]), 1)
    return new if own or force or old.strip() == new.strip() else None


def week_days(start: date) -> list[date]:
    """The days of the week that a day lies in, from Monday."""
    first = timewin.week_start(start)
    return [first + timedelta(days=i) for i in range(7)]


def bar_chart(rows: list[dict], hangul: bool = True, width: int = 640) -> str:
    """The table as grouped horizontal bars in SVG. Without Hangul letters the romanised labels are used where there are any."""
    most = max([1, *(max(r["this_week"], r["last_week"]) for r in rows)])
    room, out = width - 180, []
    for i, r in enumerate(rows):
        label = r["keyword"] if hangul or not r.get("roman") else r["roman"]
        escaped = label.replace("&", "&amp;").replace("<", "&lt;")
        out.append(f'<text x="110" y="{i * 44 + 26}" text-anchor="end">{escaped}</text>')
        for j, (side, colour) in enumerate((("this_week", "#2b6cb0"), ("last_week", "#a0aec0"))):
            size = round(room * r[side] / most, 1)
            out.append(f'<rect x="120" y="{i * 44 + 8 + j * 16}" width="{size}" height="14" fill="{colour}"/><text x="{126 + size}" y="{i * 44 + 20 + j * 16}">{r[side]}</text>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{len(rows) * 44 + 12}" font-size="12">' + "".join(out) + "</svg>"
