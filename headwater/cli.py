"""Commands over a project folder: collect, qa, brief, report and run. Exit codes: 0 done, 1 a check failed, 2 wrong use or input."""

from __future__ import annotations

import argparse
import json
import os
import sys
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater import settings
from headwater.functions import timewin, urls
from headwater.operators import brief, grouping, judging, load, quality, report, series
from headwater.session import session, settled
from headwater.sinks import messages
from headwater.sinks.versions import DayTables
from headwater.sources import articles as src

DONE, FAILED, WRONG = 0, 1, 2
#: Words that rules need where a project names none.
INTEREST, EXCLUDE, REGULATION, TOOL = ["AI", "인공지능"], ["주식", "증시"], ["규제", "법"], ["출시", "공개"]


class Project:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.config = spark, settings.load(root)
        self.words = {k: settings.word_list(self.config, k, d) for k, d in (("interest", INTEREST), ("exclude", EXCLUDE), ("regulation", REGULATION), ("tool", TOOL), ("stopwords", []))}

    def path(self, name: str) -> str:
        return self.config["paths"][name]

    def stored(self) -> DataFrame:
        found = load.stored(self.spark, "file://" + self.path("articles"))
        if found is None:
            raise FileNotFoundError("nothing is stored yet; collect a day first")
        return found.withColumn("seen_ts", F.to_timestamp("seendate", "yyyyMMdd'T'HHmmss'Z'").cast("timestamp_ntz"))

    def judged(self) -> DayTables:
        return judging.tables(self.spark, "file://" + self.path("decisions"))

    def since(self):
        """The first day that counts in means, if the settings name one."""
        found = str(settings.setting(self.config, "source_since", "") or "").strip()
        return F.lit(date.fromisoformat(found)) if found else None

    def of_day(self, day: date) -> DataFrame:
        own = self.stored().where(F.col("kst_date") == F.lit(day)).withColumn("pos", F.lit(0))
        return grouping.in_store_order(own)


def collected(project: Project, day: date, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the captured list of a day, each link once, and what was counted on the way."""
    file = Path(folder) / f"gdelt_{day.isoformat()}.json"
    raw = src.captured_list(project.spark, f"file://{file.resolve()}") if file.exists() else project.spark.createDataFrame([], src.LIST_SCHEMA.split("struct<")[1][:-2].replace(":", " "))
    first, last = (t.strftime("%Y%m%d%H%M%S") for t in timewin.day_window(day))
    rows = src.normalised(raw)
    own = settled(src.within(rows, first, last))
    kept = settled(load.keep_first(own, urls.collect_key(F.col("url")), F.col("seendate"), "url"))
    counted = load.dedupe_metrics(own, urls.collect_key(F.col("url")), "url", "seendate").select("duplicated", "merged_distinct_urls")
    lost = raw.agg(F.count_if(F.trim(F.coalesce("url", F.lit(""))) == "").alias("dropped_no_url")).crossJoin(rows.agg((F.count("*") - own.count()).alias("stray_dropped")))
    return kept.withColumn("kst_date", F.lit(day)), settled(counted.crossJoin(lost))


def checks(project: Project, day: date, articles: DataFrame, metrics: DataFrame | None, everything: bool) -> int:
    """Prints the table of checks; the exit code tells whether one failed."""
    none = project.spark.createDataFrame([], "truncated boolean")
    found = quality.collected(articles, F.lit(day), none if metrics is not None else None, metrics)
    if everything:
        stored = project.stored()
        own = project.judged().read("decisions", day, day)
        found = found.unionByName(quality.loaded(articles, project.of_day(day), series.daily_counts(stored), own, F.lit(day)))
    found = settled(found)
    for r in quality.table_lines(found).orderBy("place").collect():
        print(r.line)
    return FAILED if quality.summary(found).first().exit_code else DONE


def store(project: Project, day: date, rows: DataFrame) -> None:
    told = load.load(project.spark, rows.drop("title_raw"), "file://" + project.path("articles"), "seendate", "url")
    load.append_run(project.spark, F.lit(day), told, datetime.now(timezone.utc).isoformat(), "file://" + project.path("runs"))
    print(json.dumps(told.first().asDict()))


def judge(project: Project, day: date, backend: str | None, force: bool, answers: str | None = None) -> None:
    """Judges a day if it has to be. Answers of a model are files ``<day>.json`` or ``.txt`` in the folder ``answers``; a day without one goes to the rules."""
    wanted = backend or settings.setting(project.config, "judge.backend", "rules")
    words = judging.Words(**project.words, threshold=float(project.config["judge"]["similarity_threshold"]))
    landed = None
    if answers and list(Path(answers).glob("*.*")):
        bodies = project.spark.read.text(f"file://{Path(answers).resolve()}", wholetext=True)
        landed = bodies.select(F.to_date(F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2}-\d{2})\.\w+$", 1)).alias("kst_date"), F.col("value").alias("body")).where("kst_date is not null")
    state = judging.judge_days(project.judged(), settled(project.of_day(day)), [day], words, wanted, landed, force)
    told = project.judged().read("runs", day, day).first()
    for r in state.collect():
        print(f"{r.kst_date}: " + ("reused" if r.reused else f"decided ({r.reason})") + f", by {told.backend}" + (f": {told.fallback_reason}" if told.fallback_reason else ""))


def make_brief(project: Project, day: date) -> dict:
    own = project.config["brief"]
    groups = judging.stored_groups(project.judged(), day, day)
    p = settled(brief.prepared(groups, brief.domain_map(project.of_day(day).select("url", "domain"))))
    stats = series.daily_stats(settled(project.stored()), settings.watch_keywords(project.config) or project.words["interest"], own["average_window_days"], own["average_min_days"], own["first_seen_lookback_days"], project.since()).where(F.col("kst_date") == F.lit(day)).first()
    told = brief.notes(p, own["max_groups"], own["min_groups"]).first()
    label = f"{day.isoformat()} {brief.text.WEEKDAYS[day.weekday()]}"
    out = brief.build(label, [r.asDict() for r in brief.sections(p, own["max_groups"]).collect()], {**(stats.asDict() if stats else {"article_count": 0}), "lookback": own["first_seen_lookback_days"]}, told.asDict() if told else None, project.config["query"], own["max_keywords"], own["min_groups"])
    print(messages.save_text(out["markdown"], f"{project.path('briefs_dir')}/{day.isoformat()}.md"))
    return out


def make_report(project: Project, day: date, force: bool) -> int:
    start = timewin.week_start(day)
    days = report.week_days(start)
    if not project.judged().days():
        raise FileNotFoundError("nothing is decided yet")
    held = settled(project.judged().read("decisions", start - timedelta(days=7), days[-1]).select("kst_date", "url", "verdict"))
    names = [e["name"] for e in report.keyword_entries(project.config["keywords"])]
    before = project.stored().where(F.col("kst_date").between(F.lit(start - timedelta(days=7)), F.lit(start - timedelta(days=1))))
    counted = report.counted_weeks(series.keyword_days(before, names)) if names else None
    volume = report.weekly_volume(held, counted).where(F.col("week") == F.lit(start)).first()
    rows = [r.asDict() for r in report.week_rows(project.stored(), report.keyword_entries(project.config["keywords"]), start, project.config["report"]["top_keywords"]).collect()]
    merged = report.merge_headlines(judging.stored_groups(project.judged(), start, days[-1]).where("kind <> 'other'").withColumn("week", F.lit(start)))
    lines: dict[str, list[str]] = {}
    for r in report.group_lines(merged).orderBy("kind", "line_no").collect():
        lines.setdefault(r.kind, []).append(r.line)
    calendar = project.spark.createDataFrame([(d,) for d in days], "kst_date date")
    gaps = report.missing_days(calendar, held, timewin.local_today(datetime.now(timezone.utc).replace(tzinfo=None))).collect()
    named = {s: sorted(str(g.kst_date) for g in gaps if g.state == s) for s in ("missing", "upcoming")}
    folder = Path(project.path("reports_dir")) / start.isoformat()
    if rows:
        messages.save_text(report.bar_chart(rows), str(folder / "chart.svg"))
    words = report.markdown(start, rows, lines, volume.n_kept if volume else 0, volume.last_kept if volume else None, named["missing"], named["upcoming"], chart="chart.svg" if rows else None, source=brief.source_sentence(project.config["query"]))
    file = folder / "report.md"
    out = report.replaced(file.read_text(encoding="utf-8") if file.exists() else None, words, force)
    print(messages.save_text(out, str(file)) if out is not None else f"{file} has changes; --force writes over them")
    return DONE


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--date", type=date.fromisoformat, help="local day, YYYY-MM-DD; yesterday if not given")
    common.add_argument("--backend", choices=("rules", "llm"))
    common.add_argument("--dry-run", action=argparse.BooleanOptionalAction, default=None)
    common.add_argument("--root", default=".")
    common.add_argument("--fixtures", help="folder of captured lists, gdelt_<day>.json", default="fixtures")
    common.add_argument("--answers", help="folder of a model's answers, <day>.json")
    common.add_argument("--force", action="store_true")
    out = argparse.ArgumentParser(prog="headwater")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("collect", "qa", "brief", "report", "run"):
        own = commands.add_parser(name, parents=[common])
        if name == "report":
            own.add_argument("--week", type=date.fromisoformat)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    try:
        args = parser().parse_args(argv)
    except SystemExit as e:
        return WRONG if e.code else DONE
    day = args.date or timewin.local_today(datetime.now(timezone.utc).replace(tzinfo=None)) - timedelta(days=1)
    try:
        project = Project(spark or session(), args.root)
        if args.command == "qa":
            return checks(project, day, settled(project.of_day(day)), None, True)
        if args.command == "report":
            return make_report(project, args.week or args.date or day - timedelta(days=6), args.force)
        if args.command in ("collect", "run"):
            rows, metrics = collected(project, day, args.fixtures)
            # nothing is stored of a day that fails here
            if checks(project, day, rows, metrics, False) == FAILED:
                print(messages.failure("the day's checks failed before it was stored"))
                return FAILED
            store(project, day, rows)
            if args.command == "collect":
                return DONE
        judge(project, day, args.backend, args.force, args.answers)
        if args.command == "run" and checks(project, day, rows, metrics, True) == FAILED:
            return FAILED
        out = make_brief(project, day)
        dry = settings.setting(project.config, "notify.dry_run", True) if args.dry_run is None else args.dry_run
        print(json.dumps(messages.send(out, None if dry else os.environ.get("SLACK_WEBHOOK_URL"), dry)["status"]))
        return DONE
    except (FileNotFoundError, ValueError) as e:
        print(e, file=sys.stderr)
        return WRONG


if __name__ == "__main__":
    sys.exit(main())
