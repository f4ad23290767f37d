"""HTML, urls, quality rules and toxicity."""

from __future__ import annotations

import re
import time
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from querylode.llm import html_text, quality, toxicity, url_filter
from querylode.llm.queries import URL_RULES


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("<div>a</div><div>b</div>", "a\nb"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>d", "- a\n- b\n  - c\n\nd"), ("<ol start=9><li>a<li>b</ol>", "9. a\n10. b"),
    ("<table><tr><th>Name<th>N<tr><td>long name<td>1<tr><td colspan=2>both &amp; all</table>x", "Name       N\nlong name  1\nboth & all\n\nx"),
    ("<p hidden>a</p><p style='display : NONE'>b</p><script>x='</p>'</script>c<!-- d -->", "c"), ("<head><title>t</title><p>x", "x"),
    ("<pre>\n a\n  b</pre>", " a\n  b"), ("a < b 1<2", "a < b 1<2"), ("<a href='x>y'>l</a><unk", "l"), ("<p>a</i> b&copy", "a b©"),
    ("<input type=hidden value=1><details><summary>s</summary>no</details>", "s"), ("x<b>y</b> <i> z </i>", "xy z"), ("</p>a", "a"),
    ("<div>" * 5000 + "deep", "deep"), ("<table><td>a<table><td>b</table></table>", "a b"),
])
def test_visible_text(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize("page,text", [
    ("a<svg><title>t</title><defs><text>d</text></defs><circle r=1 /><desc/><text>Q1</text><text x='2'>Q2</text></svg>b", "a\nQ1\nQ2\nb"),
    ("<p>so <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></semantics></math> holds", "so x=2 holds"),
    ("<desc>shown</desc>", "shown"), ("a<svg/><desc>b</desc>", "ab"),
    ("<table><tr><th>A<th>B<th>C<tr><td rowspan=2>one<td>2<td>3<tr><td>4<td>5<tr><td>6<td>7<td>8</table>", "A    B  C\none  2  3\n     4  5\n6    7  8"),
    ("<table><tr><td>a<td rowspan=0>b<tr><td>c<tr><td>d<td>e</table>", "a  b\nc\nd     e"),
    ("<table><thead><tr><th rowspan=9>A<th>B</thead><tbody><tr><td>1<td>2</table>", "A  B\n1  2"),
    ("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c<tr><td>dd<td>e<td>f</table>", "a      b\n       c\ndd  e  f"),
])
def test_foreign_text_and_row_spans(page, text):
    assert html_text.extract(page) == text


def test_pages_odd_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a"), (1, "u", "<p>a"), (None, None, None)], "page_id long, url string, html string")
    rows = html_text.extract_text(pages.withColumn("text", F.lit(1)))
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, "a", 1, 1), (1, "a", 1, 1), (None, "", 0, 0)]
    assert html_text.extract_text(pages.limit(0)).count() == 0


def judged_by_rules(url):
    found = re.search(r"://", url or "")
    host = path = ""
    if found:
        rest = url[found.end():]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for _, r in URL_RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return host, path, max(fits, key=len, default=None)


def test_url_rules_and_scores(spark):
    urls = [None, "", "no scheme", "http://A.B.Com/x?y#z", "http://com", "http://com/", "https://www.Example.com/en/1", "http://example.com/en/", "http://é.net/fr/",
            "http://xcom/", "a://b://c.net/es/1", "http://x.net/en/?a=http://q.com/", "ftp://host?x", "http://h#f", "http://net/es", "http://a\nb.com/c\nd"]
    urls += [f"http://{'spam' if i % 2 else 'good'}{i}.org/{'buy-now-1234' if i % 2 else 'page'}/{i}" for i in range(60)]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, score string").withColumn("label", F.lit("x"))
    labelled = spark.createDataFrame([(u, int("spam" in u)) for u in urls[16:56]], "url string, label int")
    rows = {r.page_id: r for r in url_filter.filter_urls(pages, URL_RULES, labelled).collect()}
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule = judged_by_rules(url)
        r = rows[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        if rule:
            assert (r.verdict, rule) in URL_RULES
    assert [rows[i].verdict for i in range(72, 76)] == ["allow", "block"] * 2
    assert url_filter.filter_urls(pages.limit(0), URL_RULES).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, ()).collect()} == {"allow"}  # nothing labelled


def test_rates_count_every_labelled_url(spark, monkeypatch):
    """Trees see one url of each domain; the domain's rate comes from all its rows, and copies of one url take one place of the sample."""
    seen = []
    rates = url_filter._rates
    monkeypatch.setattr(url_filter, "_rates", lambda counted, key, name: seen.append((key, rates(counted, key, name))) or seen[-1][1])
    samples = []
    lexical = url_filter.lexical
    monkeypatch.setattr(url_filter, "lexical", lambda urls: samples.append(urls) or lexical(urls))
    urls = [(f"http://a.{'bad' if i % 2 else 'good'}{i % 10}.org/{i}", i % 2) for i in range(200)] + [("http://hot.net/", 1)] * 100
    labelled = spark.createDataFrame(urls, "url string, label int")
    labelled = labelled.withColumns({"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))})
    url_filter.fit(labelled, rows=150, trees=1)
    found = {key: {r[0]: (r[1], r[2]) for r in rows.collect()} for key, rows in seen}
    assert found["suffix"] == {"org": (101 / 202, 200.0), "net": (101 / 102, 100.0)}
    assert len(found["domain"]) == 11 and found["domain"]["bad1.org"] == (21 / 22, 20.0) and found["domain"]["hot.net"][1] == 100
    assert samples[0].count() == samples[0].distinct().count() == 150


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_measurements(spark, odd_docs, no_docs):
    texts = ["a b c d e f g h " * 2, "a b c d e f g h a", "x " * 40, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 q 1 2 3 4 5 6 7 8", "l\nl\n\n \nl", "#*$ <b> 𝔘 é", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("bits", F.lit("x"))
    rows = {r.doc_id: r for r in quality.judged(quality.ledger(df), "v2").collect()}
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_quality(text), text
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and (not r.base_failed or not r.kept)
    assert quality.ledger(odd_docs).count() == odd_docs.count() and quality.ledger(no_docs).count() == 0


def test_policies_and_ablations(odd_docs):
    rows = quality.ledger(odd_docs).cache()
    assert quality.judged(rows, "v1").where("kept").count() >= quality.judged(rows, "v2").where("kept").count()
    bits = [r.bits for r in rows.select("bits").collect()]
    for r in quality.ablations(rows, "v2").collect():
        bit = quality.mask_of((r.rule,))
        assert r.n_failed == sum(bool(b & bit) for b in bits) and r.n_failed_alone == sum(b == bit for b in bits)


@pytest.fixture(scope="module")
def disguised(spark):
    rnd = np.random.default_rng(1)
    words = "the of and water river stone green house tree light morning under walk sing table idiomatic classic lost".split()
    bad, forms = ["idiot", "clown", "loser"], {"idiot": "1d10t", "clown": "cl0wn", "loser": "l o s e r"}
    docs, labels = [], []
    for i in range(400):
        text = list(rnd.choice(words, 30))
        toxic = i % 4 == 0
        if toxic:
            word = bad[i // 4 % 3]
            text[7] = forms[word] if i % 8 == 0 else word
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_disguised_words_are_restored_and_scored(disguised):
    docs, labels = disguised
    model = toxicity.language_model(docs)
    for word, meant in (("1d10t", "idiot"), ("cl0wn", "clown"), ("l0s3r", "loser"), ("cl00wn", "clown"), ("iiidiooot", "idiot"), ("$tone", "stone")):
        assert toxicity.restore(word, model) == meant
    rows = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert rows and all(r.predicted == r.toxic for r in rows)


def test_toxicity_odd_rows(odd_docs, no_docs, disguised):
    _, labels = disguised
    rows = toxicity.score(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows) and not any(r.predicted for r in rows)
    assert toxicity.score(no_docs, labels).count() == 0
    assert toxicity.score(odd_docs, labels.limit(0)).where("predicted = 1").count() == 0
    left = toxicity.drop_toxic(odd_docs, labels)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count()


def test_disguises_pass_the_reader(disguised):
    docs, _ = disguised
    more = docs.unionByName(docs.sparkSession.createDataFrame([(1000 + i, "stupid tax scum letter ass") for i in range(60)], docs.schema))
    reader = toxicity.Reader(toxicity.language_model(more))
    for raw, meant in (("$tupid", "stupid"), ("!diot", "idiot"), ("(lown", "clown"), ("$cum", "scum"), ("stuupid", "stupid"), ("iidiot", "idiot"),
                       ("+ax", "tax"), ('"$tupid!"', "stupid"), ("tax!", "tax"), ("letter", "letter"), ("ass", "ass"), ("stone.", "stone")):
        assert meant in reader.words(raw), raw
    assert not reader.words("$100 !! 5+5")


def test_signs_and_doubled_letters_are_scored(spark, disguised):
    docs, labels = disguised
    odd = [f"river stone {w} house green" for w in ("!diot", "(lown", "iidiot", "loserr")] + ["river stone! (house lost"]
    more = docs.unionByName(spark.createDataFrame([(5000 + i, t) for i, t in enumerate(odd)], docs.schema))
    rows = {r.doc_id: r.predicted for r in toxicity.score(more, labels).where("doc_id >= 5000").collect()}
    assert rows == {5000: 1, 5001: 1, 5002: 1, 5003: 1, 5004: 0}


def test_doubled_letters_are_read_like_the_lattice(disguised):
    """The short way through words of letters with isolated doubled ones against the cheapest path of the whole lattice."""
    model = toxicity.language_model(disguised[0])
    reader, rng = toxicity.Reader(model), np.random.default_rng(3)
    words = ["".join(c * int(rng.choice([1, 1, 1, 2])) for c in rng.choice(list("aeioustlrnéxzß"), rng.integers(1, 9))) for _ in range(3000)]
    short = 0
    for w in words:
        runs = list(toxicity._RUN.finditer(w))
        found = reader._doubled(w, runs) if runs else None
        short += found is not None
        assert found in (None, toxicity.restore(w, model)), w
    assert short > 500


def test_a_reader_forgets_without_changing_its_mind(disguised):
    model = toxicity.language_model(disguised[0])
    small, large = toxicity.Reader(model, bound=8), toxicity.Reader(model)
    texts = [r.text for r in disguised[0].limit(60).collect()]
    assert [small.words(t) for t in texts * 2] == [large.words(t) for t in texts * 2]
    assert toxicity.reader_of(model) is toxicity.reader_of(model.copy())


def test_the_decoder_finds_the_cheapest_of_all_paths(disguised):
    """Viterbi against every path of the lattice, costed letter by letter."""
    model = toxicity.language_model(disguised[0])

    def cost(path):
        x = y = 0
        total = 0.0
        for _, classes, extra in path:
            total += extra
            for z in classes:
                total, x, y = total + model[x, y, z], y, z
        return total + model[x, y, 0]

    rng = np.random.default_rng(9)
    for _ in range(300):
        word = "".join(rng.choice(list("1503$!ailost.-"), rng.integers(1, 7)))
        every = {"".join(w for w, _, _ in path): cost(path) for path in sorted(product(*toxicity._readings(word)), key=cost, reverse=True)}
        assert every[toxicity.restore(word, model)] == pytest.approx(min(every.values())), word


def test_spaced_and_long_words_pass_the_reader(disguised):
    docs, _ = disguised
    more = docs.unionByName(docs.sparkSession.createDataFrame([(1000 + i, "you see a stupid tree") for i in range(60)], docs.schema))
    reader = toxicity.Reader(toxicity.language_model(more))
    for text, meant in (("s t u p i d", "stupid"), ("5 t u p i d", "stupid"), ("1 d 1 0 t", "idiot"), ("s\tt\nu p  i d", "stupid"), ("st up id", "stupid"),
                        ("s t u u u p i d", "stupid"), ("y o u s t u p i d", "stupid"), (" ".join("youareastupididiot" * 500), "idiot"),
                        ("stu" + "u" * 60 + "pid", "stupid"), ("x" * 50 + "." + "stupid" * 9, "x" + "stupid" * 9)):
        assert meant in reader.words(text), text[:60]
    assert "treelight" not in reader.words("tree light to it")
    assert not reader.words("1 2 3 4 5 6")


@pytest.mark.parametrize("page, text", [
    ('<div style="visibility:hidden">a<p style="visibility: visible">b</p>c</div>d', "b\n\nd"),
    ('<div style="display:none">a<p style="visibility: visible">b</p></div>d', "d"),
    ('x<span style="backface-visibility:hidden">y</span>', "xy"),
    ("<table><tr><td>h<ul><li>x<li>y</ul><td>one<br>two<td>z<tr><td>q<td>r</table>", "h    one  z\n- x  two\n- y\nq    r"),
])
def test_visibility_and_lines_of_cells(page, text):
    assert html_text.extract(page) == text


def test_many_open_elements_take_linear_time():
    started = time.time()
    assert html_text.extract("<p><button>" + "<div>" * 100_000 + "x") == "x"
    assert time.time() - started < 20
