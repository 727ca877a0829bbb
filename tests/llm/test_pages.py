"""WARC round trips with hostile payloads, url rules and templates."""

import hashlib
import random
import re
from collections import Counter

import pytest

from scanledger.llm import url_filter, warc
from scanledger.llm.common import shared_folder
from tests.llm.data import rows, with_clashes

PAGES = "page_id long, url string, html string"
FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 4\r\n\r\nevil\r\n\r\n"
SAME = "same " * 40


def pages():
    table = [
        (1, "http://a/", "plain"), (2, None, None), (3, "http://b\n/", ""), (4, "x", FAKE), (5, "x", "before" + FAKE * 3 + "after"),
        (6, "x", "WARC/1.1\r\n"), (7, "x", SAME), (8, "x", SAME), (9, "x", SAME), (10, "x", "short"), (11, "x", "short"),
        (12, "x", "é" * 60 + "\r\n\r\n" + "ü"), (13, "x", "WARC/1.1\r\n" * 200), (None, "x", "no id"), (14, "x", "z" * 200_000), (15, "x", "tie"),
        (15, "x", "tie"), (16, "x", "WARC/1.1\r\nContent-Length: 99999999999999999999\r\n\r\n"),
    ]
    return table + [(100 + i, f"http://h/{i}", f"page {i} " * (i % 50) + (FAKE if i % 7 == 0 else "")) for i in range(300)]


def wanted(table):
    first = {}
    for page, _, html in table:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(page, first.get(body, page))
    out = []
    for page, _, html in table:
        body = (html or "").encode()
        own = first.get(body)
        again = own is not None and own != page
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", own if again else None, True))
    return sorted(out, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def test_round_trip(spark):
    found = warc.query(with_clashes(spark.createDataFrame(pages(), PAGES)))
    assert rows(found, *COLUMNS) == wanted(pages())


def test_blocks_may_end_anywhere(spark):
    table = pages()
    folder = warc.write_archives(spark.createDataFrame(table, PAGES).coalesce(1), shared_folder(spark, "warc"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert rows(warc.read_archives(spark, folder), *COLUMNS) == wanted(table)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_pointer_jumping_takes_few_rounds_and_only_the_chain(spark):
    chain = [("f", 10 * i, 10 * (i + 1), 10 * (i + 1) + 3) for i in range(50)] + [("f", 1000, 20, 25), ("g", 0, 7, 9)]
    found = warc._entered(spark.createDataFrame(chain, "file string, run long, to long, entry_to long"))
    want = [("f", 0, 0), *(("f", 10 * i, 10 * i + 3) for i in range(1, 51)), ("g", 0, 0), ("g", 7, 9)]
    assert rows(found, "file", "run", "entry") == sorted(want, key=repr)


def test_archives_of_nothing(spark):
    assert warc.query(spark.createDataFrame([], PAGES)).count() == 0


def test_files_that_do_not_start_with_the_magic(spark, tmp_path):
    (tmp_path / "x.warc").write_bytes(b"junk" + FAKE.encode())
    assert warc.read_archives(spark, str(tmp_path)).count() == 0


# ------------------------------------------------------------------------------------------------------------ urls


def test_rules(spark):
    urls = {
        1: ("https://WWW.Example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        2: ("http://m.example.com/en/1?q=/fr/", "m.example.com", "/en/1", "example.com/en/", "block"),
        3: ("http://example.com", "example.com", "", None, "allow"),
        4: ("http://example.com/de/", "example.com", "/de/", "com/", "allow"),
        5: ("http://x.net/fr/2#a", "x.net", "/fr/2", "net/fr/", "block"),
        6: ("http://xnet/fr/2", "xnet", "/fr/2", None, "allow"),
        7: (None, "", "", None, "allow"), 8: ("no scheme", "", "", None, "allow"), 9: ("a://b?c/d", "b", "", None, "allow"),
        10: ("a://É.NET/es/", "É.net", "/es/", "net/es/", "block"),
    }
    table = [(k, v[0]) for k, v in urls.items()] + [(1, urls[1][0])]
    found = url_filter.query(with_clashes(spark.createDataFrame(table, "page_id long, url string"))).collect()
    assert len(found) == len(table)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.page_id][1:], r


def test_templates_learn_from_labels(spark):
    table = [(i, f"http://h.org/shop/item-{i}-x/view") for i in range(200)] + [(1000 + i, f"http://h.org/news/{i}") for i in range(200)]
    from pyspark.sql import functions as F

    taught = F.when(F.col("path").rlike("/shop/item-1[0-9]*-x"), "block").when(F.col("path").rlike("/news/1[0-9]*$"), "allow")
    found = url_filter.filter_urls(spark.createDataFrame(table, "page_id long, url string"), labels=taught, rules=()).collect()
    assert {r.verdict for r in found if r.page_id < 1000} == {"block"}
    assert {r.verdict for r in found if r.page_id >= 1000} == {"allow"}
    assert len({r.template for r in found}) == 2


def test_urls_of_nothing(spark):
    assert url_filter.query(spark.createDataFrame([], "page_id long, url string")).count() == 0


def brute_shape(s):
    forms = [("^$", ""), ("^[0-9]+$", "<number>"), (r"^[0-9]+\.[A-Za-z0-9]{1,5}$", "<number.file>"), ("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "<date>"),
             ("^[0-9a-fA-F-]{8,}$", "<hex>"), (r"\.[A-Za-z0-9]{1,5}$", "<file>"), ("[0-9]", "<mixed>")]
    return next((name for form, name in forms if re.search(form, s)), "<word>")


def brute_filter(rows):
    """(template, purity) of rows (host, path, label), each step with dictionaries."""
    split = [p.split("/")[1:] for _, p, _ in rows]
    shapes = [[brute_shape(s) for s in segments] for segments in split]
    places = [[(h, d, "/".join(sh[:d])) for d in range(len(sh))] for (h, _, _), sh in zip(rows, shapes)]
    total, count = Counter(), Counter()
    for segments, own in zip(split, places):
        for s, place in zip(segments, own):
            total[place] += 1
            count[place, s] += 1
    literal = {k for k, n in count.items() if n >= url_filter.MIN_SHARE * total[k[0]] and n >= url_filter.MIN_COUNT and k[1]}
    kinds = {}
    for (_, _, label), segments, sh, own in zip(rows, split, shapes, places):
        for d, (s, place) in enumerate(zip(segments, own)):
            if (place, s) in literal:
                kind = f"{sh[d + 1] if d + 1 < len(sh) else '<end>'} {label or '-'}"
                kinds.setdefault(place, {}).setdefault(s, Counter())[kind] += 1
    names = {}
    for place, held in kinds.items():
        pooled = sum(held.values(), Counter())
        everything, alike = sum(pooled.values()), []
        for s, own in held.items():
            expected = {k: sum(own.values()) * n / everything for k, n in pooled.items()}
            chi = sum((own[k] - e) ** 2 / e for k, e in expected.items())
            if chi <= url_filter.MAX_CHI * max(len(pooled) - 1, 1):
                alike.append(s)
        for s in held:
            names[place, s] = "{" + "|".join(sorted(alike)) + "}" if s in alike else s
    made = ["/".join(names.get((place, s), shape) for s, place, shape in zip(seg, own, sh)) for seg, own, sh in zip(split, places, shapes)]
    bad, seen = Counter(), Counter()
    for (host, _, label), template in zip(rows, made):
        for key in ((), (host,), (host, template)):
            bad[key] += label == "block"
            seen[key] += label is not None
    k = url_filter.STRENGTH
    base = bad[()] / seen[()] if seen[()] else 0.0
    out = []
    for (host, _, _), template in zip(rows, made):
        own = (bad[host,] + k * base) / (seen[host,] + k)
        prior = own if seen[host, template] else min(own, base)
        out.append((template, (bad[host, template] + k * prior) / (seen[host, template] + k)))
    return out


def test_templates_by_brute_force(spark):
    draw = random.Random(21)
    words = ["en", "fr", "es", "news", "shop", "blog", "tag"]
    tail = lambda: draw.choice(["", str(draw.randint(0, 999)), f"a{draw.randint(0, 99)}", "2024-01-02", f"{draw.randint(1, 9)}.html", "deadbeef01", "x.css", draw.choice(words)])
    urls = [None, "none", "http://one.com"] * 20 + ["http://one.com/" + "long/" * 3_000 + "x"]
    for _ in range(1500):
        host = draw.choice(["www.example.com", "m.example.com", "a.net", "a.net", "b.org", "hot.org", "hot.org"])
        urls.append(f"http://{host}/" + "/".join([draw.choice(words) for _ in range(draw.randint(0, 2))] + [tail()]))
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r for r in url_filter.query(with_clashes(table)).collect()}
    labels = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block", None: None}
    rows_ = [(found[i].host, found[i].path, labels[found[i].rule]) for i in range(len(urls))]
    for i, (template, purity) in enumerate(brute_filter(rows_)):
        r = found[i]
        assert r.template == template and r.purity == pytest.approx(purity, rel=1e-9), urls[i]
        assert r.verdict == (rows_[i][2] or ("block" if purity >= url_filter.MAX_PURITY else "allow"))
