"""Main text, URL filter, fingerprints, line removal and toxicity on small fixtures."""

import os
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from txscore.llm import catalog, html_text, line_dedup, prefix_hash, toxicity, url_filter

P = "A sentence of the article, long enough to count, with commas and all. " * 3
Q = "Another paragraph that says something else about the very same matter. " * 3

PAGES = {
    "template": (f"<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul>"
                 f"<li><a href='/a'>a</a></li><li><a href='/b'>b</a></li></ul></nav><div class='ad'>{P}</div>"
                 f"<article><h1>Title &amp; more</h1><p><b>{P}<br><p>{Q}</p></article><footer>&copy; x</footer>",
                 ["Title & more", P, Q]),
    "divisions": (f"<body><div id='header'><h1>Site</h1></div><div class='wrap'><div class='post'><h2>Head</h2>"
                  f"<p>{P}</p><p>{Q}</p><ul><li>one<li>two</ul></div><div class='sidebar'><p>{P}</p></div></div>"
                  f"<div id=comments><div class=comment><p>{P}</p></div></div><form><p>Sign up</p><input></form>"
                  f"<div class='cookie-notice'>We use cookies. {P}</div></body>", ["Head", P, Q, "one", "two"]),
    "plain": (f"<ul><li><a href=1>Home</a><li><a href=2>About us</a></ul><h1>T</h1><p>{P}<p>{Q}<p>Short.",
              ["T", P, Q, "Short."]),
    "table": (f"<table><tr><td><a href=x>menu</a></td><td><p>{P}</p><p>{Q}</p></td></tr></table>", [P, Q]),
    "hidden": (f"<article><p>{P}</p><p hidden>{Q}</p><aside>x</aside><section class='reader-comments'>{Q}</section>"
               f"<p style='display:none'>no</p><!-- <p>no</p> --><p title=\"a>b\">{Q}</p></article>", [P, Q]),
    "wrappers": (f"<body><div class='site has-sidebar'><div class='content no-sidebar'><h1>T</h1><p>{P}</p><p>{Q}</p>"
                 f"</div><div class='sidebar'><p>{P}</p></div></div><div id=comments><div class=comment><p>{Q}</p></div>"
                 f"</div></body>", ["T", P, Q]),
    "named article": (f"<main><article class='post comments-open'><h1>T</h1><p>{P}</p><section class=comments><p>{Q}"
                      f"</p></section><p>{Q}</p></article></main><div><p>{P[:80]}</div>", ["T", P, Q]),
    "named page": (f"<div id='social-policy'><p>{P}<p>{Q}</div><div class='cookie-notice'>We use cookies.</div>", [P, Q]),
    "named article below more text": (
        f"<div class=page-with-header><article class=has-related><p>{P}<p>{Q}</article></div>"
        f"<div class=ad><p>{P}</div>", [P, Q]),
    "text in a named element only": (f"<body class=x><div class='modal-open'>{P}</div></body>", [P]),
    "advert longer than the article": (f"<div class='ad'>{P}</div><article><h1>T</h1><p>Short.</article>", ["T", "Short."]),
    "links of an article": (f"<div><a href=1>Home</a> <a href=2>News</a></div><article><p>{P}</p><p>{Q}</p><ul><li>"
                            f"<a href=1>Source one</a><li><a href=2>Source two</a></ul></article>",
                            [P, Q, "Source one", "Source two"]),
    "long comments beside the article": (f"<article><h1>T</h1><p>{P}<p>{Q}</article><section class='comments'>"
                                         + f"<p>{Q}</p>" * 30 + "</section>", ["T", P, Q]),
    "long comments beside divisions": (f"<div class=content><p>{P}<p>{Q}</div><div id=comments>" + f"<p>{P}</p>" * 30
                                       + "</div>", [P, Q]),
    "long comments in main": (f"<main><p>{P}<p>{Q}<div id=comments>" + f"<p>{P}</p>" * 30 + "</div></main>", [P, Q]),
    "long comments in the article": (f"<article><p>{P}<section class='reader-comments'>" + f"<p>{P}</p>" * 30
                                     + f"</section><p>{Q}</article>", [P, Q]),
    "articles as comments": (f"<article><p>{P}<p>{Q}</article><ol class=commentlist>"
                             + f"<li><article class='comment-body'><p>{P}{P}</article>" * 20 + "</ol>", [P, Q]),
    "long sidebar": (f"<article><p>{P}<p>{Q}</article><div class='sidebar'>" + f"<p>{P}{P}</p>" * 10 + "</div>", [P, Q]),
    "long notice in the article": (f"<article><div class='cookie-notice'>{P * 5}</div><p>{P}<p>{Q}</article>", [P, Q]),
    "page in a form": (f"<form id='aspnetForm'><input><article><p>{P}<p>{Q}</article><div class=sidebar><p>{P}</div>"
                       "<button>Send</button></form>", [P, Q]),
    "divisions in a form": (f"<p>Site</p><form><div><p>{P}<p>{Q}</div><div id=comments><p>{P}{Q}</div></form>", [P, Q]),
    "comments only": (f"<div id=comments><div class=comment><p>{P}</div></div>", [P]),
    "banner around main": (f"<p>Site</p><div class=banner><main><p>{P}<p>{Q}</main></div>", [P, Q]),
    "deep strong names": ("<div class='sidebar'>" * 3000 + P, [P]),
    "deep names": ("<div class='has-sidebar'>" * 3000 + P, [P]),
    "references": ("<p>a &lt;b&gt;&#x41;&nbsp;&nbsp; x<br>y</p>", ["a <b>A x y"]),
    "text": ("just  text", ["just text"]),
    "broken quote": (f'<p a="x>{P}</p>', [P]),
    "deep": ("<div>" * 5000 + P, [P]),
    "open script": (f"<p>{P}</p><script>x", [P]),
    "nothing": ("<html></html>", []),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    source, blocks = PAGES[name]
    assert html_text.main_text(source) == "\n".join(" ".join(b.split()) for b in blocks)


def test_extract_rows(spark):
    rows = [(1, "u", PAGES["template"][0], "x"), (1, "u", PAGES["template"][0], "x"), (2, None, None, "x"),
            (None, "v", "", "x"), (3, "w", "<p>long " * 50_000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): r.text for r in html_text.extract(df).collect()}
    assert got[2, None] == "" == got[None, "v"] and got[1, "u"].startswith("Title & more\n")
    assert got[3, "w"].count("long") == 50_000
    assert html_text.extract(df.limit(0)).collect() == []


URLS = ["https://www.Example.COM/en/a?b=1", "http://example.com/en/", "http://example.com/en", "http://x.example.com/fr/",
        "http://a.net/es/1", "http://net/fr/x", "http://a.net/de/1", "http://a.net/de/1/", "http://A.net:80/de/1#x",
        "http://b.org/?q=2&p=1&utm_source=x", "https://b.org/?p=1&q=2", "http://notexample.com/en/", "http://com",
        "ftp://user@example.com/en/", "no scheme", "", None, "a://b://c.com/", "http://www.example.com?x=/en/",
        "http://example.com:8080/en/x", "http://a.org/\n/x"]


def test_url_query_equals_sql(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, u, "p", "r") for i, u in enumerate(URLS + rng.choices(URLS, k=200))] + [(None, URLS[0], "p", "r")]
    spark.createDataFrame(rows, "page_id long, url string, html string, rule string").write.parquet(
        f"{tmp_path}/pages.parquet")
    got = catalog.op3_url_filter(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    con.execute("CREATE VIEW p2 AS SELECT page_id, coalesce(url, '') AS url, html FROM pages")
    want = con.execute(catalog.OP3_SQL.replace("FROM pages)", "FROM p2)")).fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, (tuple(r) for r in got.collect()))) == sorted(map(key, want))
    verdicts = {r.page_id: (r.rule, r.verdict) for r in got.collect() if r.page_id is not None}
    assert verdicts[0] == ("www.example.com/en/", "allow") and verdicts[1] == ("example.com/en/", "block")
    assert verdicts[2] == ("com/", "allow") and verdicts[6] == (None, "block") and verdicts[16] == (None, "allow")


def test_bloom_filter_has_no_false_negatives_and_the_join_removes_false_positives(spark):
    rows = [(i, f"http://h{i % 400}.org/{i % 700}") for i in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i}.org/{i}",) for i in range(0, 400, 7)], "address string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    want = {i for i, u in rows if int(u.split("/")[-1]) == (h := int(u[8:].split(".")[0])) and h % 7 == 0}
    for blocks in (1, 1 << 12, None):  # a filter of one block lets nearly everything pass
        got = url_filter.judge(pages, rules, listed, blocks=blocks).collect()
        assert {r.page_id for r in got if r.verdict == "block"} == want and len(got) == len(rows)
    none = spark.createDataFrame([], "address string")
    assert {r.verdict for r in url_filter.judge(pages, rules, none).collect()} == {"allow"}
    assert url_filter.judge(pages.limit(0), rules, listed).collect() == []


def test_bloom_filter_is_sized_by_its_keys(spark, monkeypatch):
    assert [url_filter.blocks_for(n) for n in (0, 1, 16, 17, 1000, 1 << 40)] == [
        1, 1, 1, 2, 64, url_filter.MAX_BLOCKS]
    keys = [f"page {i}.org/{i * i}" for i in range(5000)]
    others = [f"page {i}.net/{i}" for i in range(20_000)]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    bloom = url_filter.build(df, url_filter.blocks_for(len(keys)))
    assert url_filter.passes(bloom, keys).all() and url_filter.passes(bloom, others).mean() < 0.005
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1 << 7)  # 6.5 bits a key
    full = url_filter.build(df, url_filter.blocks_for(len(keys)))
    assert url_filter.passes(full, keys).all() and url_filter.passes(full, others).mean() < 0.2


def test_prefix_hashes_answer_spans_and_extensions():
    rng = random.Random(2)
    for _ in range(60):
        a, b = ("".join(rng.choices("abñ😀", k=rng.randint(1, 80))) for _ in range(2))
        x, y = prefix_hash.PrefixHash(a), prefix_hash.PrefixHash(b)
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        assert x.extension(i, y, j) == len(os.path.commonprefix([a[i:], b[j:]]))
        n = rng.randint(0, min(len(a) - i, len(b) - j))
        assert (x.span(i, i + n) == y.span(j, j + n)) == (a[i:i + n] == b[j:j + n])


def test_compare_with_next_equals_definition(spark):
    rng = random.Random(3)
    words = ["w%d" % i for i in range(500)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 300))) for _ in range(60)] + ["", None, "ab", "ñ" * 50_000]
    ids = rng.sample(range(-500, 500), len(texts))
    rows = [(i, t, "x", 1.0) for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, th double").repartition(5)
    got = {r.doc_id: r for r in prefix_hash.compare_with_next(df).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert sorted(got) == sorted(ids)
    for k, (i, t, *_) in enumerate(order):
        t, follow = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        edited = t[:len(t) - n] + follow[:n]
        r = got[i]
        assert (r.n_chars, r.edited) == (len(t), edited)
        assert r.fingerprint == prefix_hash.Fingerprinted(0, t).finger
        assert r.edited_fingerprint == prefix_hash.Fingerprinted(0, edited).finger
        assert r.common_prefix == len(os.path.commonprefix([t, edited]))
        if len(t) > 600 and len(set(t)) > 2:
            assert 0.45 < r.near_edited < 0.9 and r.near_next < 0.2


def test_compare_with_next_ties_nulls_and_small_tables(spark):
    rows = [(3, "c" * 40), (3, "c" * 40), (None, "n" * 40), (1, "a" * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = prefix_hash.compare_with_next(df).collect()
    assert sorted((r.doc_id or 0, r.edited[-1]) for r in got) == [(0, "c"), (1, "n"), (3, "a"), (3, "c")]
    assert sorted(r.near_next for r in got)[-1] == 1.0
    one = prefix_hash.compare_with_next(df.where("doc_id = 1")).collect()
    assert one[0].edited == "a" * 40 and one[0].near_edited == 1.0
    assert prefix_hash.compare_with_next(df.limit(0)).collect() == []


@pytest.mark.parametrize("hot", [7, None, 1 << 52])
def test_compare_with_next_splits_a_hot_id(spark, hot):
    rng = random.Random(4)
    texts = ["t%d " % i * rng.randint(1, 9) for i in range(400)]
    rows = [(hot, t) for t in texts] + [(hot, "same text")] * 50 + [
        (i, "o%d " % i * 5) for i in [*range(-40, 60), (1 << 52) + 1, (1 << 52) - 1] if i != hot]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    # signed xxhash64 is the order of equal ids
    th = {r.text: r.th for r in df.select("text", F.xxhash64("text").alias("th")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -th[r[1]]))
    want = []
    for (i, t), (_, follow) in zip(order, order[1:] + order[:1], strict=True):
        n = len(t) // 3
        edited = t[:len(t) - n] + follow[:n]
        mine, other, theirs = (prefix_hash.Fingerprinted(0, x).finger for x in (t, edited, follow))
        want.append((str(i), edited, mine, other, prefix_hash.likeness(mine, other),
                     prefix_hash.likeness(mine, theirs)))
    got = prefix_hash.compare_with_next(df).collect()
    assert sorted((str(r.doc_id), r.edited, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
                  for r in got) == sorted(want)
    dealt = prefix_hash._in_order(df).where("not guest").groupBy("bucket").count().collect()
    different = max(r["count"] for r in dealt)
    assert different < 150 and sum(r["count"] for r in dealt) == len(rows)


def lines_brute(rows, unit):
    sep = "\n" if unit == "line" else None
    seen, out = set(), {}
    for i, text in sorted(rows):
        parts = text.split(sep) if sep else re.split("\n(?:[\x09\x0b-\x0d\x20]*\n)+", text)
        kept = []
        for p in parts:
            norm = re.sub("[\x09-\x0d\x20]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), p)).strip(" ")
            if norm and norm in seen:
                continue
            seen.add(norm)
            kept.append(p)
        out[i] = ("\n" if sep else "\n\n").join(kept)
    return out


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_line_removal_equals_brute_force(spark, unit):
    rng = random.Random(4)
    pool = ["Line %d  x" % (i % 40) for i in range(80)] + ["", " ", "é\tÉ", "LINE 3 X", "  line 3 x "]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 30)))) for i in range(-40, 40)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, start string, digest string")
    got = line_dedup.remove_repeats(df.repartition(4), unit=unit).collect()
    assert {r.doc_id: r.text for r in got} == lines_brute(rows, unit)
    texts = dict(rows)
    for r in got:
        spans = sorted([(s.start, s.end) for s in [*r.kept, *r.removed]])
        assert spans == line_dedup.cut(texts[r.doc_id], unit) and r.n_units == len(spans)


def test_short_lines_stay(spark):
    df = spark.createDataFrame([(1, "One two\nA  b c\nx"), (2, "a B c \none two\nx")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.remove_repeats(df, min_words=3).collect()}
    assert got == {1: "One two\nA  b c\nx", 2: "one two\nx"}


def test_line_removal_nulls_repeated_rows_empty_table(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (None, "b\nc"), (2, None), (0, "x\nx\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in line_dedup.remove_repeats(df).collect())
    assert [g[1] for g in got] == ["x\n", "a\nb", "a\nb", None, "c"]
    assert line_dedup.remove_repeats(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        line_dedup.remove_repeats(df, unit="word")


def labelled(spark, n=1500, rare=0):
    rng = random.Random(5)
    words = ["word%s" % "abcdefghijklmnop"[i % 16] * (i // 16 + 1) for i in range(80)]
    insults = ["idiot"] * 8 + ["".join(rng.choices("kqzxv", k=4)) for _ in range(rare)]
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.2
        w = rng.choices(words, k=rng.randint(5, 60))
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(insults)
        # in this sample insults often go with one group, though the group says nothing
        if rng.random() < (0.7 if toxic else 0.05):
            w.insert(rng.randrange(len(w)), "muslims")
        rows.append((i, " ".join(w), 9, "z"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label long, own string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_toxicity_held_out_and_neutral_mentions(spark):
    docs, labels, truth = labelled(spark)
    got = toxicity.toxicity(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_penalty_spares_neutral_mentions(spark):
    docs, labels, _ = labelled(spark, rare=60)  # most insults are too rare to be learnt
    plain = toxicity.fit(docs, labels, swap_penalty=0.0)
    fair = toxicity.fit(docs, labels)
    neutral, others = "muslims live in this town", "buddhists live in this town"
    assert plain.score(neutral) > 0.5 > fair.score(neutral)
    assert abs(fair.score(neutral) - fair.score(others)) < 0.1
    assert fair.score("you idiot") > 0.5


def test_toxicity_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels, truth = labelled(spark, 600)
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(toxicity.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    score = lambda lab: sorted((r.doc_id, r.score) for r in toxicity.toxicity(docs, lab).collect())
    assert score(labels) == score(flipped)


def test_toxicity_edge_rows(spark):
    docs, labels, _ = labelled(spark, 400)
    odd = spark.createDataFrame([(None, "idiot"), (5000, None), (5001, ""), (5001, ""), (5002, "x " * 300_000)],
                                "doc_id long, text string")
    nulls = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.unionByName(nulls))
    got = toxicity.score(odd, model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (5000, 5001)} == {model.score("")}
    assert toxicity.score(odd.limit(0), model).collect() == []
    assert toxicity.fit(docs, labels.limit(0)).score("idiot") == 0.5
    one = toxicity.fit(docs, labels.where("toxic = 0")).score("idiot")
    assert one < 0.01
    kept = toxicity.clean(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()




def test_a_repeated_id_fits_one_row(spark, monkeypatch):
    rows = [(i % 40 if i < 80 else 0, f"plain words {i}" if i % 2 else f"awful words {i}", i) for i in range(400)]
    docs = spark.createDataFrame([*rows, (0, None, 0)], "doc_id long, text string, n int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    sets, seen = toxicity._sets, []
    monkeypatch.setattr(toxicity, "_sets", lambda r, *a: seen.append(r.collect()) or sets(r, *a))
    toxicity.fit(docs, labels, max_fit=30, rounds=2)
    assert {len(r) for r in seen} == {30} and all(x.text for x in seen[0])
