"""URL filter: held-out accuracy of the model, rules and parts over all pages against brute force, empty and repeated rows."""

import re
import zlib

from pricelens.llm import urls
from pricelens.llm.common import table
from pricelens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy_and_margin(spark):
    rows = sorted(set(urls.labelled_urls()))
    held = [r for r in rows if zlib.crc32(r[0].encode()) % 5 == 0]
    rest = [r for r in rows if zlib.crc32(r[0].encode()) % 5]
    model = urls.train_url_model(spark.createDataFrame(rest, "url string, label int"))
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(held)], "page_id long, url string")
    score = {r.page_id: r.score for r in urls.judge_urls(pages, model, rules=[]).collect()}
    unwanted = [score[i] for i, (_, label) in enumerate(held) if label]
    ordinary = [score[i] for i, (_, label) in enumerate(held) if not label]
    assert len(unwanted) > 60 and len(ordinary) > 250
    assert sum(s >= 0.5 for s in unwanted) >= 0.85 * len(unwanted) and sum(s < 0.5 for s in ordinary) >= 0.95 * len(ordinary)
    assert sorted(unwanted)[len(unwanted) // 4] - sorted(ordinary)[3 * len(ordinary) // 4] > 0.4


def test_the_labelled_table_names_no_host_of_the_pages(spark):
    hosts = {r.host for r in QUERIES["op6_urls"](spark, SF).select("host").distinct().collect()}
    assert not hosts & {re.sub(r"^https?://([^/?#]*).*", r"\1", u) for u, _ in urls.labelled_urls()}


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def test_every_page_against_brute_force(spark):
    pages = {r.page_id: r.url for r in table(spark, SF, "pages").select("page_id", "url").collect()}
    got = QUERIES["op6_urls"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path = parts(pages[r.page_id])
        fits = [(len(h + p), v, h + p) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits)[1:] if fits else (None, None)
        assert (r.host, r.path, r.rule) == (host, path, rule[1])
        assert r.verdict == (rule[0] or ("block" if r.score >= 0.5 else "allow")) and 0 <= r.score <= 1


def test_empty_tables_and_repeated_rows(spark):
    model = urls.default_model(spark)
    pages = spark.createDataFrame([(1, "http://a.com/de/x"), (1, "http://a.com/de/x"), (None, None)], "page_id long, url string")
    assert sorted((str(r.page_id), r.host, r.rule) for r in urls.judge_urls(pages, model).collect()) == [
        ("1", "a.com", "com/de/"), ("1", "a.com", "com/de/"), ("None", "", None)]
    assert urls.judge_urls(pages.limit(0), model).count() == 0
