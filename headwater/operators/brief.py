"""The brief of a day: groups with outlets and places, notes in numbers, and its text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwater.functions import text, urls
from headwater.functions.wording import BRIEF
from headwater.session import settled

KINDS = ("tool", "policy", "other")


def domain_map(*sources: DataFrame) -> DataFrame:
    """url and domain from several tables of them; the first table that knows a link counts."""
    ranked = [s.where((F.coalesce("url", F.lit("")) != "") & (F.coalesce("domain", F.lit("")) != "")).select(text.clean_prose(F.col("url")).alias("url"), F.struct(F.lit(i).alias("i"), text.clean_prose(F.col("domain")).alias("domain")).alias("d")) for i, s in enumerate(sources)]
    return reduce(DataFrame.union, ranked).groupBy("url").agg(F.min("d")["domain"].alias("domain"))


def prepared(groups: DataFrame, domains: DataFrame, day: str = "kst_date") -> DataFrame:
    """Groups (day, group_id, headline, kind, urls) with link, domains, counts and place: most outlets first, then most articles, then as given.

    The outlet of a link is what the map says, else its host. Groups without headline and links go.
    """
    clean = F.filter(F.transform("urls", text.clean_prose), lambda u: u != "")
    kind = F.lower(text.clean_prose(F.col("kind")))
    rows = groups.select(day, "group_id", text.sentence(F.col("headline")).alias("headline"), F.when(kind.isin(*KINDS), kind).otherwise("other").alias("kind"), clean.alias("urls")).where((F.col("headline") != "") | (F.size("urls") > 0))
    # written once, as both sides of the join below come from it
    rows = settled(rows)
    each = rows.select(day, "group_id", F.posexplode("urls").alias("at", "url")).join(domains, "url", "left")
    outlet = F.coalesce(F.lower("domain"), urls.outlet(F.when(F.instr("url", "//") > 0, F.col("url")).otherwise(F.concat(F.lit("//"), "url"))))
    own = each.select(day, "group_id", "at", outlet.alias("domain")).where("domain <> ''").groupBy(day, "group_id").agg(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("at", "domain"))), lambda x: x["domain"])).alias("domains"))
    out = rows.join(own, [day, "group_id"], "left").withColumn("domains", F.coalesce("domains", F.array().cast("array<string>")))
    n, article_count = F.size("domains"), F.size("urls")
    out = out.withColumns({"domain_count": F.when(n > 0, n).otherwise(article_count), "article_count": article_count, "link": F.coalesce(urls.tidy(F.get("urls", 0)), F.lit("")), "headline": F.when(F.col("headline") != "", F.col("headline")).otherwise(BRIEF["no_headline"])})
    place = F.row_number().over(Window.partitionBy(day).orderBy(F.desc("domain_count"), F.desc("article_count"), "group_id"))
    return out.withColumn("place", place)


def sections(groups: DataFrame, most: int = 5, lead: bool = True) -> DataFrame:
    """Prepared groups within the budget, which the lead and the rules take part in; ``lead`` False where a summary was given."""
    section = F.when(F.lit(lead) & (F.col("place") == 1), "lead").when(F.col("kind") == "policy", "policy").otherwise("general")
    return groups.where(F.col("place") <= most).withColumn("section", section)


def notes(groups: DataFrame, most: int = 5, least: int = 3, day: str = "kst_date") -> DataFrame:
    """For each day how many groups there are, how many several outlets told, how many are shown, and whether that is too few."""
    out = groups.groupBy(day).agg(F.count("*").alias("total"), F.count_if(F.col("domain_count") >= 2).alias("multi"), F.count_if(F.col("place") <= most).alias("shown"))
    return out.withColumn("cut", F.col("total") > F.col("shown")).withColumn("too_few", F.col("shown") < min(least, most))


def number(x: float) -> str:
    """One decimal at most."""
    out = round(float(x), 1)
    return str(int(out)) if abs(out - int(out)) < 1e-9 else str(out)


def volume_sentence(count: int | None, mean: float | None, days_used: int | None = None) -> str:
    if count is None:
        return ""
    known = bool(mean and mean > 0)
    if count == 0:
        return BRIEF["none_with_mean"].format(mean=number(mean)) if known else BRIEF["none"]
    out = BRIEF["count"].format(n=count)
    if not known:
        return out + ("" if days_used is None else BRIEF["no_history"] if days_used == 0 else BRIEF["short_history"].format(days=days_used))
    trend = "similar" if abs(count - mean) < max(1.0, mean * 0.05) else "more" if count > mean else "fewer"
    return out + BRIEF[trend].format(mean=number(mean), diff=number(abs(count - mean)))


def source_sentence(query: str = "") -> str:
    return BRIEF["source"] + (BRIEF["query"].format(query=query) if query else "") + BRIEF["read"]


def _item(row: dict) -> list[str]:
    parts = [BRIEF["outlets"].format(n=row["domain_count"])] + ([BRIEF["new_tool"]] if row["kind"] == "tool" else []) + ([row["link"]] if row["link"] else [])
    return ["- " + row["headline"], "  " + " · ".join(parts)]


def build(day_label: str, rows: list[dict], stats: dict, told: dict | None = None, query: str = "", most_keywords: int = 8, least: int = 3) -> dict:
    """Markdown, summary line and message blocks of a day from the few rows that ``sections`` keeps.

    ``day_label``: day and weekday. ``stats``: article_count, avg_7d, days_used, first_seen, skipped and lookback, as ``daily_stats`` has them. ``told``: the day's ``notes``.
    """
    title = BRIEF["title"].format(day=day_label)
    count, mean = stats.get("article_count"), stats.get("avg_7d")
    words = list(dict.fromkeys(w for w in stats.get("first_seen") or [] if w))
    lines = [volume_sentence(count, mean, stats.get("days_used"))]
    rows = sorted(rows, key=lambda r: r["place"])
    lead = next((r for r in rows if r["section"] == "lead"), None)
    parts: list[tuple[str, list[str]]] = []
    if rows:
        summary = lead["headline"] if lead else rows[0]["headline"]
        shown, total, multi = len(rows), (told or {}).get("total", len(rows)), (told or {}).get("multi", 0)
        if total > shown:
            lines.append(BRIEF["cut_many" if multi else "cut_single"].format(total=total, multi=multi, shown=shown))
        if shown < least:
            lines.append(BRIEF["too_few"].format(shown=shown, least=least))
        general = [r for r in rows if r["section"] == "general"]
        if general:
            parts.append((BRIEF["general"], [x for r in general for x in _item(r)]))
    else:
        summary = BRIEF["quiet_none"] if count == 0 else BRIEF["quiet"]
        lines = [] if count == 0 and not (mean and mean > 0) else lines
    if stats.get("skipped"):
        lines.append(BRIEF["keywords_empty"].format(days=stats.get("lookback", 7)))
    if words:
        line = " · ".join(words[:most_keywords]) + (f" 외 {len(words) - most_keywords}개" if len(words) > most_keywords else "")
        cut = " " + BRIEF["keywords_cut"].format(total=len(words), shown=most_keywords) if len(words) > most_keywords else ""
        parts.append((BRIEF["keywords"], [line, "", BRIEF["keywords_why"] + cut]))
    policy = [r for r in rows if r["section"] == "policy"]
    if policy:
        parts.append((BRIEF["policy"], [x for r in policy for x in _item(r)]))
    top = ["## " + title, "", summary]
    if lead:
        top.append(BRIEF["lead_many"].format(n=lead["domain_count"]) if lead["domain_count"] >= 2 else BRIEF["lead_one"])
        top += [BRIEF["link"].format(link=lead["link"])] if lead["link"] else []
    lines = [x for x in lines if x]
    body = top + (["", *lines] if lines else [])
    for heading, content in parts:
        body += ["", "### " + heading, "", *content]
    source = source_sentence(query)
    blocks = [{"type": "header", "text": {"type": "plain_text", "text": title[:150], "emoji": False}}, _section("\n".join(top[2:]))]
    blocks += [_context("\n".join(lines))] if lines else []
    blocks += [_section(f"*{heading}*\n" + "\n".join(content)) for heading, content in parts]
    return {"markdown": "\n".join([*body, "", source, ""]), "summary_line": summary, "slack_blocks": [*blocks, _context(source)], "group_total": (told or {}).get("total", len(rows)), "group_shown": len(rows)}


def _section(words: str) -> dict:
    return {"type": "section", "text": {"type": "mrkdwn", "text": words if len(words) <= 3000 else words[:2997].rstrip() + "..."}}


def _context(words: str) -> dict:
    return {"type": "context", "elements": [_section(words)["text"]]}
