"""Commands over a project in a temporary folder: order, exit codes, and that running again changes nothing."""

import json
from pathlib import Path

import pytest

from headwater import cli


@pytest.fixture
def root(tmp_path):
    (tmp_path / "config").mkdir()
    (tmp_path / "config/keywords.json").write_text(json.dumps({"keywords": ["AI", "구글"]}))
    fixtures = tmp_path / "fixtures"
    fixtures.mkdir()
    item = lambda i, title, at, host="a": {"url": f"https://www.{host}.kr:443/{i}?utm_source=x", "title": title, "seendate": at, "domain": f"{host}.kr", "language": "Korean"}
    rows = [item(1, "AI 규제 법 통과", "20260910T150000Z"), item(2, "AI 규제 법 통과 됐다", "20260911T010000Z", "b"), item(3, "구글 AI 공개", "20260911T020000Z"), item(4, "AI 주식 오른다", "20260911T030000Z"), {**item(1, "AI 규제 법 통과", "20260910T151500Z"), "url": "http://m.a.kr/1#top"}]
    (fixtures / "gdelt_2026-09-11.json").write_text(json.dumps({"articles": rows}))
    stray = [item(9, "AI", "20260910T000000Z"), item(8, "AI 둘", "20260911T160000Z")]
    (fixtures / "gdelt_2026-09-12.json").write_text(json.dumps({"articles": stray}))
    return tmp_path


def run(spark, root, *args):
    return cli.main([*args, "--root", str(root), "--fixtures", str(root / "fixtures")], spark)


def test_run_and_report(spark, root, capsys):
    assert run(spark, root, "run", "--date", "2026-09-11") == cli.DONE
    first = capsys.readouterr().out
    assert '"inserted": 4' in first and "decided (none)" in first and '"dry_run"' in first
    brief = (root / "data/briefs/2026-09-11.md").read_text()
    assert brief.startswith("## 2026-09-11 금요일") and "매체가 2곳으로" in brief and "https://www.a.kr/1" in brief
    assert run(spark, root, "run", "--date", "2026-09-11") == cli.DONE
    again = capsys.readouterr().out
    assert '"inserted": 0' in again and "reused" in again and (root / "data/briefs/2026-09-11.md").read_text() == brief
    assert run(spark, root, "report", "--week", "2026-09-09") == cli.DONE
    report = root / "data/reports/2026-09-07/report.md"
    words = report.read_text()
    assert "| AI | 4 |" in words and (Path(report).parent / "chart.svg").exists()


def test_a_failing_day_stores_nothing(spark, root):
    # one of two rows lies outside the day, so its ratio is over the limit
    assert run(spark, root, "run", "--date", "2026-09-12") == cli.FAILED
    assert not (root / "data/articles").exists()
    assert run(spark, root, "collect", "--date", "2026-09-13") == cli.FAILED
    assert run(spark, root, "brief", "--date", "2026-09-11") == cli.WRONG
    assert run(spark, root, "unknown") == cli.WRONG and cli.main(["run", "--date", "soon"]) == cli.WRONG
