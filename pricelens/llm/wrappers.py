"""Main text of web pages by wrappers: union-free regular expressions inferred from all pages of one host.

A page is a sequence of block tags and text slots.  The wrapper of a host
starts as one of its pages, with adjacent equal runs folded into repeated
groups, and is aligned with one page of another structure after the other: where they differ,
the difference is a repeated group if one side continues a run, else the part
that has no partner becomes optional.  Each text slot of a wrapper is marked
as main text or not, by the tags around it and by whether its text is the same
on all pages of the host; a page takes the marks of the slots it matches.  A
host whose structures don't fit into one wrapper of MOST_NODES has several,
and a page takes the first that it matches.
"""

from __future__ import annotations

import html
import itertools
import json
import re

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.session import release

from .common import pick, row_slices, written
from .urls import host_and_path

#: Tags whose content is not markup, other tags whose content is dropped unread, tags inside a line of text, tags and names of page furniture.
RAW = "script|style|textarea|title"
UNREAD = set("noscript template iframe svg select button object canvas audio video".split())
INLINE = set("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base col embed hr input link meta param source track".split())
FURNITURE = set("aside dialog footer form head menu nav".split())
FURNITURE_NAMES = set("ad ads alert banner breadcrumb breadcrumbs byline consent disqus footer form header login masthead menu modal nav navbar "
                      "newsletter notice notices popup promo related reply respond search share sharing side signup social subscribe toolbar widget "
                      "navigation contentinfo complementary".split())
FURNITURE_STARTS = ("advert", "comment", "cookie", "sidebar", "sponsor", "navig")
CONTENT_NAMES = set("article content entry main post story".split())
CLOSED_BY = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
OPTIONAL_END = set("body colgroup head html tbody tfoot thead".split())
BLOCKS_END_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())

MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^<>]*(?<!/)>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:(?:\"[^\"<]*\"|'[^'<]*'|[^<>\"'])*+|[^<>]*))>|<[!?][^<>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
#: Marks of slots by their place; a page's text is that of its highest mark.
MAIN, OTHER, OPEN = 2, 1, -1
MARKS = {"main": MAIN, "": OTHER, "drop": 0}
#: A wrapper takes in the structures of its host while it has at most so many nodes; the others make up further wrappers of the host.
MOST_NODES = 4_096
RAW_NAME = re.compile(RAW)
WORDS = re.compile(r"[a-z0-9]+")


def _named(attributes: str) -> tuple[str, list[str], bool]:
    """(label part, words of class, id and role, hidden)."""
    if not attributes:
        return "", [], False
    found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)}
    words = WORDS.findall(" ".join(found.get(k, "") for k in ("class", "id", "role")))
    return "".join(f" {k}={found[k]}" for k in ("class", "id") if found.get(k)), words, "hidden" in found


def _kind(name: str, words: list[str], hidden: bool, in_content: bool) -> str:
    """What a block's text is: "drop", "main" or "" (as around it).

    Names of the page as a whole say nothing about its parts; an article's own
    names only whether it is a comment, an advert or a link to another one.
    """
    if name in ("body", "html"):
        return ""
    if name in ("article", "main"):
        aside = hidden or any(w in ("ad", "promo", "related", "reply") or w.startswith(("advert", "comment", "sponsor")) for w in words)
        return "drop" if aside else "main"
    if hidden or name in FURNITURE or any(w in FURNITURE_NAMES or w.startswith(FURNITURE_STARTS) for w in words):
        return "drop"
    if name == "header":
        return "" if in_content else "drop"
    return "main" if any(w in CONTENT_NAMES for w in words) else ""


def page_tokens(page: str | None) -> tuple[list[str], list[str], list[str]]:
    """(labels, texts, places) of a page.

    Labels are block tags (without end tags that HTML lets out) and ``#`` for a run of text; texts and places are
    those of the ``#`` in order, a place being "drop", "main" or "".  Unread elements end with their end tag or that
    of an element around them; without any end tag of their name after them they are empty.
    """
    labels, texts, places, stack, run, at = [], [], [], [], [], 0
    unread, lower = None, None

    def end_run():
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            kinds = [k for _, k in stack]
            labels.append("#")
            texts.append(text)
            places.append("drop" if "drop" in kinds else "main" if "main" in kinds else "")

    def close(names) -> None:
        while stack and stack[-1][0] in names:
            stack.pop()

    page = page or ""
    for m in MARKUP.finditer(page):
        if unread is None:
            run.append(page[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if name in UNREAD and not m[2]:
            if lower is None:
                lower = page.lower() if page.isascii() else re.sub("[A-Z]+", lambda x: x[0].lower(), page)
            if not m[4].endswith("/") and lower.find(f"</{name}", at) >= 0:
                unread = len(stack) if unread is None else unread
                stack.append((name, "drop"))
            continue
        if unread is not None:
            opened = [x for x, _ in stack]
            if m[2] and name in opened[unread:]:
                while stack.pop()[0] != name:
                    pass
                if len(stack) <= unread:
                    unread = None
                continue
            if not (m[2] and name in opened):
                if name and not m[2] and name not in INLINE and name not in VOID and not m[4].endswith("/"):
                    stack.append((name, "drop"))
                continue
            del stack[unread:]
            unread = None
        if name in UNREAD or RAW_NAME.fullmatch(name):
            continue
        if not name or name in INLINE:
            if name == "br":
                run.append(" ")
            continue
        end_run()
        if m[2]:
            if any(x == name for x, _ in stack):
                while stack.pop()[0] != name:
                    pass
                if name not in CLOSED_BY and name not in OPTIONAL_END:
                    labels.append(f"/{name}")
            continue
        label, words, hidden = _named(m[4])
        if name == "body":
            close({"head"})
        close(CLOSED_BY.get(name, set()) | ({"p"} if name in BLOCKS_END_P else set()))
        labels.append(name + label)
        if name not in VOID and not m[4].endswith("/"):
            stack.append((name, _kind(name, words, hidden, any(k == "main" for _, k in stack))))
    if unread is None:
        run.append(page[at:])
    end_run()
    return labels, texts, places


# A wrapper is a list of nodes: a label, ["#", place, texts seen], ["?", nodes] or ["+", nodes].

def _same(a, b) -> bool:
    if isinstance(a, str) or isinstance(b, str):
        return a == b
    if a[0] == b[0] == "#":
        return a[1] == b[1]
    return a[0] == b[0] != "#" and (len(a[1]) == len(b[1]) and all(map(_same, a[1], b[1])))


def _merged(a, b):
    """Two nodes that are the same as one: slots remember the texts of both."""
    if isinstance(a, str):
        return a
    if a[0] == "#":
        return ["#", a[1], a[2] + b[2]]
    return [a[0], [_merged(x, y) for x, y in zip(a[1], b[1])]]


def fold(nodes: list, longest: int = 24) -> list:
    """Adjacent equal runs as repeated groups, short runs first."""
    for size in range(1, longest + 1):
        out, i = [], 0
        while i < len(nodes):
            block, j = nodes[i:i + size], i + size
            if len(block) == size and not (size == 1 and not isinstance(block[0], str) and block[0][0] in "+?"):
                while j + size <= len(nodes) and all(map(_same, block, nodes[j:j + size])):
                    block = [_merged(x, y) for x, y in zip(block, nodes[j:j + size])]
                    j += size
            if j > i + size:
                out.append(["+", block])
                i = j
            else:
                out.append(nodes[i])
                i += 1
        nodes = out
    return nodes


def _starts(nodes: list, block: list) -> bool:
    return len(nodes) >= len(block) and all(map(_same, nodes, block))


def align(a: list, b: list, reach: int = 200) -> list:
    """One wrapper for both: equal parts stay, runs become repeated groups, parts without partner optional."""
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        x, y = a[i] if i < len(a) else None, b[j] if j < len(b) else None
        if x is not None and y is not None and _same(x, y):
            out.append(_merged(x, y))
            i, j = i + 1, j + 1
            continue
        if x is not None and y is not None and x[0] == y[0] == "+" and _same(x[1][0], y[1][0]):
            out.append(["+", align(x[1], y[1], reach)])
            i, j = i + 1, j + 1
            continue
        group = next(((k, n, rest) for k, n, rest in ((0, x, b[j:j + reach]), (1, y, a[i:i + reach]))
                      if n is not None and not isinstance(n, str) and n[0] in "+?" and _starts(rest, n[1])), None)
        if group:
            side, node, rest = group
            out.append([node[0], [_merged(p, q) for p, q in zip(node[1], rest)]])
            i, j = (i + 1, j + len(node[1])) if side == 0 else (i + len(node[1]), j + 1)
            continue
        if x is not None and not isinstance(x, str) and x[0] == "?":
            out.append(x)
            i += 1
            continue
        # The nearest place where a tag or group of one side has its partner in the other.
        step = next(((di, total - di) for total in range(1, reach) for di in range(total, -1, -1)
                     if i + di < len(a) and j + total - di < len(b) and a[i + di][0] != "#" and _same(a[i + di], b[j + total - di])),
                    (len(a) - i, len(b) - j))
        for part in (a[i:i + step[0]], b[j:j + step[1]]):
            if part:
                out.append(["?", part])
        i, j = i + step[0], j + step[1]
    return out


def infer(pages: list[str]) -> list:
    """The wrapper of the pages: its slots, numbered, as ["#", mark, number].

    Marks are MAIN (in main content), 0 (furniture), OTHER (neither, with
    different texts on the pages) or OPEN (neither, with one text so far).
    """
    wrapper = None
    for page in pages:
        labels, texts, places = page_tokens(page)
        slots = iter([["#", p, [t]] for p, t in zip(places, texts)])
        nodes = fold([next(slots) if x == "#" else x for x in labels])
        wrapper = nodes if wrapper is None else align(wrapper, nodes)
    return numbered(wrapper or [])


def numbered(wrapper: list) -> list:
    """A wrapper with marks and numbers for its slots' places and texts."""
    numbers = itertools.count()

    def marked(node):
        if isinstance(node, str):
            return node
        if node[0] != "#":
            return [node[0], [marked(x) for x in node[1]]]
        place, seen = node[1], node[2]
        return ["#", OPEN if place == "" and len(set(seen)) <= 1 else MARKS[place], next(numbers)]

    return [marked(x) for x in wrapper]


def joined(wrappers, others: list | None = None) -> list:
    """One wrapper of several; those that would make it longer than MOST_NODES are put into ``others``."""
    out = None
    for nodes in wrappers:
        both = nodes if out is None else align(out, nodes)
        if out is None or size_of(both) <= MOST_NODES:
            out = both
        elif others is not None:
            others.append(nodes)
    return out or []


def all_joined(drawn: list[tuple]) -> list[tuple]:
    """(draw, wrapper) of as many wrappers as it takes to hold all those in ``drawn``, each with the draw of its first."""
    draws = {id(nodes): draw for draw, nodes in drawn}
    out, rest = [], [nodes for _, nodes in drawn]
    while rest:
        others: list = []
        out.append((draws[id(rest[0])], joined(rest, others)))
        rest = others
    return out


def size_of(nodes: list) -> int:
    return sum(1 if isinstance(n, str) or n[0] == "#" else 1 + size_of(n[1]) for n in nodes)


def slots_of(nodes: list) -> list[list]:
    """All slots of a wrapper."""
    return [x for n in nodes if not isinstance(n, str) for x in ([n] if n[0] == "#" else slots_of(n[1]))]


def match(nodes: list, labels: list[str], at: int, marks: list[list]) -> int | None:
    """End of the match of ``nodes`` from ``at``, its slots appended to ``marks``; None if there is none."""
    for node in nodes:
        if isinstance(node, str):
            if at >= len(labels) or labels[at] != node:
                return None
            at += 1
        elif node[0] == "#":
            if at >= len(labels) or labels[at] != "#":
                return None
            marks.append(node)
            at += 1
        else:
            found = 0
            while True:
                kept = len(marks)
                end = match(node[1], labels, at, marks)
                if end is None or end == at:
                    del marks[kept:]
                    break
                at, found = end, found + 1
                if node[0] == "?":
                    break
            if node[0] == "+" and not found:
                return None
    return at


def matched(wrapper: list, labels: list[str], places: list[str]) -> list[list] | None:
    """The slots of a whole page; None if the wrapper doesn't match it, or only with slots that stand elsewhere in it."""
    slots: list[list] = []
    if match(wrapper, labels, 0, slots) != len(labels):
        return None
    fits = all(mark == MARKS[p] or mark == OPEN and p == "" for (_, mark, _), p in zip(slots, places))
    return slots if fits else None


def first_matched(wrappers, labels: list[str], places: list[str]) -> tuple[int, list[list]] | None:
    """Number and slots of the first of a host's wrappers that matches a whole page."""
    for i, wrapper in enumerate(wrappers):
        slots = matched(wrapper, labels, places)
        if slots is not None:
            return i, slots
    return None


def main_text(page: str | None, wrapper: list | None, template: frozenset[int] = frozenset()) -> str:
    """Main text blocks of a page, one a line.

    What is inside main content, or on a page without such text all that isn't
    furniture nor a slot of ``template``.  A page that its wrapper doesn't match is marked by its own tags.
    """
    return main_text_by(page, [] if wrapper is None else [wrapper], [template])


def main_text_by(page: str | None, wrappers: list[list], templates: list[frozenset[int]]) -> str:
    """``main_text`` by the first of several wrappers that matches the page, and its template."""
    labels, texts, places = page_tokens(page)
    found = first_matched(wrappers, labels, places)
    if found is not None:
        template = templates[found[0]]
        marks = [0 if n in template else OTHER if mark == OPEN else mark for _, mark, n in found[1]]
    else:
        marks = [MARKS[p] for p in places]
    best = max(marks, default=0)
    return "\n".join(t for t, mark in zip(texts, marks) if mark and mark == best)


def _structures(rows: DataFrame) -> DataFrame:
    """host, draw, wrapper: every different sequence of tags and slots of a host's pages, once, and its hash."""
    arrow = pa.schema([("host", pa.string()), ("draw", pa.int64()), ("wrapper", pa.string())])

    def run(batches):
        seen = set()
        for b in row_slices(batches):
            found = []
            for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                labels, _, places = page_tokens(page)
                slots = iter(places)
                code = json.dumps([["#", next(slots), []] if x == "#" else x for x in labels])
                key = host, xxhash.xxh3_64_intdigest(code) - (1 << 63)
                if key not in seen:
                    seen.add(key)
                    found.append((*key, code))
            if len(seen) > 200_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate(arrow.types)], schema=arrow)

    return rows.where("html is not null").select("host", "html").mapInArrow(run, "host string, draw long, wrapper string").dropDuplicates(["host", "draw"])


def _joined_group(first: bool, last: bool):
    """The function that joins a group of wrappers; in the first round they are pages, in the last one a host's are numbered."""

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("draw")
        nodes = [fold(x) if first else x for x in map(json.loads, pdf["wrapper"])]
        draws, wrappers = zip(*all_joined(list(zip(pdf["draw"].tolist(), nodes))))
        wrappers = [numbered(w) if last else w for w in wrappers]
        is_open = [last and any(s[1] == OPEN for s in slots_of(w)) for w in wrappers]
        return pd.DataFrame({"of": [pdf["host"].iloc[0]] * len(draws), "draw": draws, "wrapper": [json.dumps(w) for w in wrappers], "open": is_open})

    return learn


def _learned(rows: DataFrame, at_once: int) -> DataFrame:
    """of, draw, wrapper, open: the wrappers of every host from all its structures, and whether they have open slots.

    Structures are joined in rounds, about ``at_once`` of a host in a group by
    hash, until one group a host is left or full wrappers leave nothing to join,
    so no task gathers a host.
    """
    now, before, turn = written(_structures(rows)), None, 0
    while True:
        parts = now.groupBy("host").agg(F.ceil(F.count("*") / F.lit(at_once)).cast("int").alias("parts"), F.count("*").alias("n"))
        several, left = parts.where("parts > 1").agg(F.count("*"), F.sum("n")).first()
        last = not several or left == before
        learn = _joined_group(turn == 0, last)
        draw = F.hash("draw") if turn == 0 else F.hash("draw", F.lit(turn))  # other groups in every round
        dealt = now.join(parts, "host").withColumn("part", F.pmod(draw, F.col("parts"))).select("host", "part", "draw", "wrapper")
        out = written(dealt.groupBy("host", "part").applyInPandas(learn, "of string, draw long, wrapper string, open boolean"))
        release(now)
        if last:
            return out
        now, before, turn = out.select(F.col("of").alias("host"), "draw", "wrapper"), left, turn + 1


def _per_host(wrappers: DataFrame, parts) -> DataFrame:
    """host, part, wrappers: all wrappers of a host, with draw and template, in one order."""
    of = wrappers.groupBy("of").agg(F.sort_array(F.collect_list(F.struct("draw", "wrapper", "template"))).alias("wrappers"))
    return of.select("of", "wrappers", parts)


def _template(dealt: DataFrame, wrappers: DataFrame, parts, least: int = 3) -> DataFrame:
    """(of, draw, template: numbers of the open slots that hold one whole text on all matched pages, ``least`` different ones or more).

    Pages differ if their texts beside furniture do.  Only hosts with open slots are read.  Each task sends a few rows a slot:
    smallest and largest text hash, whether a page lacks it, some page hashes.
    """
    arrow = pa.schema([("of", pa.string()), ("draw", pa.int64()), ("slot", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("lacks", pa.bool_()),
                       ("page", pa.int64())])
    hashed = lambda text: xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)

    def run(batches):
        known: dict[str, tuple] = {}
        seen: dict[tuple, list] = {}

        def out():
            found = [(*at, low, high, lacks, page) for at, (low, high, lacks, pages) in seen.items() for page in pages or [None]]
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate(arrow.types)], schema=arrow)

        def parsed(code):
            if code not in known:
                if len(known) > 2_000:
                    known.clear()
                wrapper = json.loads(code)
                known[code] = wrapper, [n for _, mark, n in slots_of(wrapper) if mark == OPEN]
            return known[code]

        for b in row_slices(batches):
            for host, page, own in zip(*(b.column(i).to_pylist() for i in range(3))):
                labels, texts, places = page_tokens(page)
                met = first_matched((parsed(w["wrapper"])[0] for w in own), labels, places)
                if met is None:
                    continue
                which, slots = own[met[0]], met[1]
                here: dict[int, list[int]] = {}
                for text, (_, mark, n) in zip(texts, slots):
                    if mark == OPEN:
                        here.setdefault(n, []).append(hashed(text))
                page_draw = hashed("\n".join(t for t, (_, mark, _) in zip(texts, slots) if mark))
                for n in parsed(which["wrapper"])[1]:
                    old = seen.setdefault((host, which["draw"], n), [None, None, False, []])
                    if n not in here:
                        old[2] = True
                        continue
                    old[0] = min(here[n]) if old[0] is None else min(old[0], *here[n])
                    old[1] = max(here[n]) if old[1] is None else max(old[1], *here[n])
                    if len(old[3]) < least and page_draw not in old[3]:
                        old[3].append(page_draw)
            if len(seen) > 50_000:
                yield out()
                seen.clear()
        yield out()

    opened = wrappers.where("open").select("of").distinct()
    hosts = _per_host(wrappers.join(opened, "of", "left_semi"), parts).withColumnRenamed("of", "host")
    met = dealt.where("html is not null").join(hosts, ["host", "part"]).select("host", "html", "wrappers")
    return met.mapInArrow(run, "of string, draw long, slot int, low long, high long, lacks boolean, page long").groupBy("of", "draw", "slot") \
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("lacks").alias("lacks"), F.count_distinct("page").alias("pages")) \
        .where(F.expr(f"low = high and not lacks and pages >= {least}")).groupBy("of", "draw").agg(F.sort_array(F.collect_list("slot")).alias("template"))


def extract(pages: DataFrame, sample: int = 64, deal: int = 16) -> DataFrame:
    """page_id, url, text, n_chars for every row.

    A wrapper is learned per host from all its pages, ``sample`` different
    structures at a time, or several where they don't fit into one; which of its slots hold the same text everywhere is then
    asked of all pages, too, and every page is extracted in full.  Pages meet their
    host's wrapper in a join whose rows are dealt over ``deal`` keys a host, so
    a host that holds a third of all pages is spread.  A null or empty page
    gives an empty text; pages without a host share one wrapper; repeated rows
    give a row each.
    """
    rows = pick(pages, "page_id", "url", "html").withColumn("host", host_and_path(F.col("url"))[0])
    wrappers = _learned(rows, max(sample, 2))
    parts = F.explode(F.sequence(F.lit(0), F.lit(deal - 1))).alias("part")
    dealt = rows.withColumn("part", F.pmod(F.hash("page_id", "url"), F.lit(deal)))
    none = F.expr("cast(array() as array<int>)")
    if not wrappers.where("open").isEmpty():
        template = written(_template(dealt, wrappers.withColumn("template", none), parts))
        wrappers = wrappers.join(template, ["of", "draw"], "left").withColumn("template", F.coalesce("template", none))
    else:
        wrappers = wrappers.withColumn("template", none)
    wrappers = _per_host(wrappers, parts)
    met = dealt.join(wrappers, (dealt["host"] == wrappers["of"]) & (dealt["part"] == wrappers["part"]), "left").select("page_id", "url", "html", "wrappers")
    arrow = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        known: dict[str, list] = {}
        for b in row_slices(batches):
            out = []
            for page, own in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                found = []
                for w in own or ():
                    if w["wrapper"] not in known:
                        if len(known) > 2_000:
                            known.clear()
                        known[w["wrapper"]] = json.loads(w["wrapper"])
                    found.append(known[w["wrapper"]])
                out.append(main_text_by(page, found, [frozenset(w["template"]) for w in own or ()]))
            yield pa.RecordBatch.from_pydict({"page_id": b.column(0), "url": b.column(1), "text": out, "n_chars": [len(t) for t in out]}, schema=arrow)

    return met.select(F.col("page_id").cast("long"), "url", "html", "wrappers") \
        .mapInArrow(run, "page_id long, url string, text string, n_chars long")
