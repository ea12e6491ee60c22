"""Messages and pages as plain payloads, and their delivery. Nothing is sent unless asked for."""

from __future__ import annotations

import json
import re
import urllib.error
import urllib.request
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.functions import text

#: Limits and forms of the receiving services.
BLOCKS, CHARACTERS, PREVIEW, TIMEOUT = 100, 2000, 200, 15
TITLE, EMPTY = "AI 뉴스 브리핑", "보낼 내용이 비어 있다."
INLINE = re.compile(r"\[(?P<words>[^\]]*)\]\((?P<link>[^)\s]+)\)|\*\*(?P<bold>.+?)\*\*")
LINES = (("heading", re.compile(r"^(#{1,6})\s+(.*)$")), ("quote", re.compile(r"^>()\s?(.*)$")), ("bulleted_list_item", re.compile(r"^[-*+]()\s+(.*)$")), ("numbered_list_item", re.compile(r"^\d+[.)]()\s+(.*)$")))


def message(payload) -> dict:
    """What a message hook takes, from text, blocks, or a built brief. Blocks get a line of text for the list of notices."""
    if payload is None or isinstance(payload, str):
        return {"text": EMPTY if payload is None else payload}
    if not isinstance(payload, dict):
        return {"text": str(payload)}
    line = str(payload.get("summary_line") or "").strip() or TITLE
    blocks = payload.get("slack_blocks", payload.get("blocks"))
    if blocks is not None:
        return {**{k: v for k, v in payload.items() if k not in ("slack_blocks", "summary_line", "markdown", "group_total", "group_shown")}, "blocks": blocks, "text": str(payload.get("text") or "").strip() or line}
    if "text" in payload or "markdown" in payload:
        return {"text": str(payload.get("text", payload.get("markdown")))}
    return {"text": json.dumps(payload, ensure_ascii=False)}


def pieces(words: str, link: str | None = None, bold: bool = False) -> list[dict]:
    return [{"type": "text", "text": {"content": words[i : i + CHARACTERS], "link": {"url": link} if link else None}, "annotations": {"bold": bold}} for i in range(0, len(words), CHARACTERS)]


def inline(line: str) -> list[dict]:
    """A line's text with its links and bold words. Only whole addresses become links; a picture shows as its words."""
    out, at = [], 0
    for m in INLINE.finditer(line):
        picture = m["link"] is not None and line[at : m.start()].endswith("!")
        out += pieces(line[at : m.start() - picture])
        if m["bold"] is not None:
            out += pieces(m["bold"], bold=True)
        else:
            whole = m["link"].lower().startswith(("http://", "https://"))
            out += pieces(m["words"] or m["link"], m["link"] if whole else None)
        at = m.end()
    return out + pieces(line[at:]) or pieces(" ")


def blocks(markdown: str) -> list[dict]:
    """Markdown as page blocks: headings of three levels, quotes, both kinds of lists, dividers and paragraphs."""
    out = []
    for line in filter(None, map(str.strip, (markdown or "").splitlines())):
        if line in ("---", "***", "___"):
            out.append({"object": "block", "type": "divider", "divider": {}})
            continue
        kind, words = next(((f"heading_{min(len(m[1]), 3)}" if k == "heading" else k, m[2]) for k, form in LINES if (m := form.match(line))), ("paragraph", line))
        out.append({"object": "block", "type": kind, kind: {"rich_text": inline(words)}})
    return out


def page_requests(parent: str, title: str, markdown: str) -> list[dict]:
    """The bodies that make a page: the first creates it with its first blocks, the others add to it."""
    all_ = blocks(markdown)
    parts = [all_[i : i + BLOCKS] for i in range(0, len(all_), BLOCKS)] or [[]]
    return [{"parent": {"page_id": parent}, "properties": {"title": {"title": pieces(title)}}, "children": parts[0]}, *({"children": p} for p in parts[1:])]


def failure(what) -> str:
    """A line for an alert, from text, an exception, or the result of checks."""
    if isinstance(what, BaseException):
        return f"{type(what).__name__}: {what}"
    if isinstance(what, dict):
        failed = [str(c.get("check") or c.get("name")) for c in what.get("checks") or [] if c.get("status") == "fail"]
        return ", ".join(failed) or str(what.get("summary") or what.get("reason") or what)
    return str(what)


def _masked(words: str, *secrets: str) -> str:
    for s in secrets:
        if s and len(s) >= 4:
            words = words.replace(s, text.MASK if len(s) < 8 else s[:2] + text.MASK)
    return words


def post(url: str, body: dict, headers: dict | None = None) -> tuple[int | None, str]:
    request = urllib.request.Request(url, json.dumps(body, ensure_ascii=False).encode(), {"Content-Type": "application/json", **(headers or {})})
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:
            return answer.status, answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")
    except OSError as e:
        return None, str(e)


def send(payload, url: str | None, dry_run: bool = True, poster: Callable = post) -> dict:
    """Sends a message: status is dry_run, skipped (no address), sent or failed. The address never shows."""
    body = message(payload)
    if dry_run or not url:
        return {"status": "dry_run" if dry_run else "skipped", "payload": body}
    code, answer = poster(url, body)
    return {"status": "sent" if code and 200 <= code < 300 else "failed", "code": code, "response": _masked(answer, url)[:PREVIEW], "payload": body}


def send_page(parent: str | None, title: str, markdown: str, send_one: Callable[[int, dict, str | None], tuple[int | None, str]] | None = None, dry_run: bool = True, token: str = "") -> dict:
    """Makes a page in requests of ``BLOCKS`` blocks: status is dry_run, skipped, sent, partial (a later request failed) or failed.

    ``send_one`` takes the number of the request, its body and the new page's id, and gives the status code and the answer.
    """
    if dry_run or not (parent and send_one):
        return {"status": "dry_run" if dry_run else "skipped", "requests": page_requests(parent or "", title, markdown)}
    page = None
    for i, body in enumerate(page_requests(parent, title, markdown)):
        code, answer = send_one(i, body, page)
        if not (code and 200 <= code < 300):
            return {"status": "partial" if i else "failed", "sent": i, "page_id": page, "code": code, "response": _masked(answer, token)[:PREVIEW]}
        if i == 0:
            try:
                page = json.loads(answer).get("id")
            except (ValueError, AttributeError):
                page = None
    return {"status": "sent", "sent": i + 1, "page_id": page}


def save_text(words: str, path: str) -> str:
    """A text file with a final line break; folders are made."""
    out = Path(path).expanduser().resolve()
    out.parent.mkdir(parents=True, exist_ok=True)
    out.write_text(words if words.endswith("\n") else words + "\n", encoding="utf-8")
    return str(out)


def raw_audit(windows: DataFrame, metrics: DataFrame, query: str, path: str) -> None:
    """The audit document of a collection, a JSON line a window, with the query and what was counted. The commit protocol leaves no half file."""
    windows.crossJoin(F.broadcast(metrics)).withColumn("query", F.lit(query)).write.mode("overwrite").json(path)
