"""Edge cases of every operator on small fixtures: nulls, empty texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import html
import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import decontaminate, html_text, line_dedup, mixing, near_dup, pii, quality, sharding, url_lists, vector_join
from skein.llm.common import Workspace, components, running

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def ws(spark, tmp_path):
    return Workspace(spark, "test")


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", 0) for i, t in texts], DOCS)


def words(n, seed=0, vocab=5000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocab)}" for _ in range(n)]


# ---- shared pieces


def test_running_sums_are_exact_over_a_hot_key(spark, ws):
    rows = spark.range(5000).select(F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 10).alias("k"), F.col("id").alias("o"), (F.col("id") % 5 + 1).alias("a"))
    got = running(ws, "r", rows, "k", ["o"], F.col("a"), rows_per_bucket=300).collect()
    sums = {}
    for r in sorted(got, key=lambda r: (r.k, r.o)):
        assert r.before == sums.get(r.k, 0)
        sums[r.k] = r.before + r.a
    assert len(got) == 5000


def test_components(spark, ws):
    edges = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (7, 7)] + [(200, x) for x in range(201, 260)]
    got = dict(map(tuple, components(ws, "c", spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(1, 41)) and got[102] == got[101] == 100 and all(got[x] == 200 for x in range(201, 260))
    assert components(ws, "e", spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; shoulders</h1><p>One<br>two   <b>three</b></p><form>Sign up</form>
<p>Four &lt;five&gt;</p><section id="comments"><p>Nice post</p></section></article><aside>Related</aside><footer>&copy; me</footer></body></html>"""


def test_page_structure():
    lines = html_text.page_lines(PAGE)
    best = max(k for _, k, _ in lines)
    assert [t for t, k, _ in lines if k == best] == ["Head & shoulders", "One two three", "Four <five>"]


def test_common_is_a_longest_common_subsequence():
    def length(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    r = random.Random(3)
    for _ in range(200):
        a, b = ([r.randrange(5) for _ in range(r.randrange(12))] for _ in range(2))
        got = html_text.common(a, b)
        assert all(a[x] == b[y] for x, y in got) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:])) and len(got) == length(a, b)
    assert len(html_text.common(["x"] * 2000, ["x"] * 1500)) == 1500  # matched by occurrence: all pairs would be three million


def test_headings_and_fallback_text_belong_to_the_article():
    page = "<main><h1>Head</h1><div class='byline'>x</div><div class='article-body'><p>One <math>a+b</math></p><object>Two</object></div><div class='related'>No</div></main>"
    lines = html_text.page_lines(page)
    best = max(k for _, k, _ in lines)
    assert [t for t, k, _ in lines if k == best] == ["Head", "One a+b", "Two"]


def test_differencing_decides_without_article_markup(spark, ws):
    def page(i, body):
        return (i, f"https://e.org/news/{i}", f"<body><div>Top story today</div><div>{body}</div><div>All rights kept</div></body>", 1)

    rows = [page(1, "First text"), page(2, "Second text"), (3, None, PAGE, 1), (4, "https://x.org/", None, 1), (5, "not a url", "", 1), (None, "https://e.org/news/0", PAGE, 1), page(2, "Second text")]
    rows += [(7, "https://copy.org/a", "<p>Same</p>", 1), (8, "https://copy.org/b", "<p>Same</p>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").withColumns({"_host": F.lit(1), "_key": F.lit(1), "n_chars": F.lit(1)})
    out = html_text.main_text(ws, df)
    got = {r.page_id: r.text for r in out.collect()}
    assert got[1] == "First text" and got[2] == "Second text" and got[4] == got[5] == "" and got[7] == got[8] == "Same"
    assert got[3] == got[None] == "Head & shoulders\nOne two three\nFour <five>"
    assert out.count() == len(rows) and out.columns == ["page_id", "url", "text", "n_chars", "n_lines", "n_differenced"]
    assert html_text.main_text(Workspace(spark, "t2"), out.select("page_id", "url", F.lit("").alias("html")).limit(0)).count() == 0
    assert html.unescape("&copy") == "©"


def site(host, n, seed):
    """Pages of one host: boilerplate from a small stock, articles of their own, a sentence that some articles share, copies."""
    r, out = random.Random(seed), []
    stock = [[f"{host} notice {place}{k}" for k in range(5)] for place in "abcd"]  # a page holds no line twice
    for i in range(n):
        body = "".join(f"<p>{' '.join(words(12, seed * 1000 + i * 10 + k))}</p>" for k in range(4)) + ("<p>The same quoted sentence.</p>" if i % 7 == 0 else "")
        if i and r.random() < 0.1:
            body = out[-1][2].split("<!--b-->")[1]
        top, end, one, two = map(r.choice, stock)
        out.append((None, f"https://{host}/a/{r.randrange(9)}/{i}", f"<body><div class='x{i}'>{top}</div><div id=t><!--b-->{body}<!--b--></div><div class='y'><p>{end}</p><p>shown to {i}</p></div><ul><li>{one}<li>{two}</ul></body>"))
    return out


def brute_main_text(pages, near, recurring, least):
    """Pairs all pages of a host, keeps the near ones, and aligns lines by a table."""
    def shared(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in reversed(range(len(a))):
            for j in reversed(range(len(b))):
                t[i][j] = t[i + 1][j + 1] + 1 if a[i] == b[j] else max(t[i + 1][j], t[i][j + 1])
        return t[0][0]

    hosts, out, seen_by = {}, {}, {}
    for i, url, source in pages:
        host, _, path = url.removeprefix("https://").partition("/")
        hosts.setdefault(host, []).append((path, i, html_text.page_lines(source, hints=False)))
    for host, rows in hosts.items():
        rows.sort()
        votes, hits, cuts, compared = {}, {i: set() for _, i, _ in rows}, {i: set() for _, i, _ in rows}, set()
        for x, (_, i, a) in enumerate(rows):
            for y, (_, j, b) in enumerate(rows):
                if x == y or abs(x - y) > near:
                    continue
                own, other = [t for t, _, _ in a], [t for t, _, _ in b]
                both = set(own) & set(other)  # in these pages a line that both hold can be aligned unless lines cross
                if shared(own, other) < len(both):
                    both = {own[p] for p, _ in html_text.common(own, other)}
                share = sum(map(len, both)) / min(sum(map(len, own)), sum(map(len, other)))
                if share < 0.8:
                    cuts[i] |= both
                if share < 0.5:
                    compared.add(i)
                    hits[i] |= both
        for _, i, a in rows:
            if i in compared:
                for t, _, block in a:
                    v = votes.setdefault(block, [0, 0])
                    v[0] += 1
                    v[1] += t in hits[i]
        template = {b for b, (n, again) in votes.items() if n >= least and again >= recurring * n + 1}
        steady = {b for b, (n, again) in votes.items() if n >= least} - template
        for _, i, a in rows:
            kept = [t for t, _, b in a if b not in template]
            if 2 * sum(map(len, kept)) < sum(len(t) for t, _, _ in a) or len(kept) == len(a):
                kept = [t for t, _, b in a if t not in cuts[i] or b in steady] or [t for t, _, _ in a]
            out[i] = "\n".join(kept)
        seen_by[host] = template
    return out, seen_by


def test_differencing_matches_brute_force_without_markup(spark, ws, monkeypatch):
    monkeypatch.setattr(html_text, "GROUP", 40)  # several groups, with borders inside a host
    pages = [(k, u, h) for k, (_, u, h) in enumerate(site("a.org", 90, 1) + site("b.org", 45, 2) + site("c.org", 3, 3) + site("d.org", 1, 4))]
    want, templates = brute_main_text(pages, html_text.NEAR, html_text.RECURRING, html_text.LINES)
    out = html_text.main_text(ws, spark.createDataFrame(pages, "page_id long, url string, html string"), hints=False).collect()
    assert {r.page_id: r.text for r in out} == want and len(templates["a.org"]) >= 3
    big = [r for r in out if r.url.startswith("https://a.org")]
    assert all("notice" not in r.text and "shown to" not in r.text for r in big) and sum("quoted" in r.text for r in big) > 8, "template goes, also what recurs nowhere; a quoted sentence stays"


def test_markup_and_differencing_agree(spark, ws):
    boxed = lambda h: h.replace("<div id=t>", "<article>").replace("<!--b--></div>", "</article>")
    pages = [(k, u, boxed(h)) for k, (_, u, h) in enumerate(site("a.org", 60, 1))] + [(900, "https://a.org/long", "<article>" + "<p>word </p>" * 30_000 + "</article>")]
    got = {r.page_id: r for r in html_text.main_text(ws, spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i, _, source in pages:
        assert got[i].text == "\n".join(t for t, k, _ in html_text.page_lines(source) if k == html_text.ARTICLE)
    assert sum(r.n_differenced for r in got.values()) > 150


# ---- 2

SAMPLES = {
    "card": "4111 1111 1111 1111", "iban": "DE89 3704 0044 0532 0130 00", "ip": "97.51.17.173", "date": "2024-02-29", "ssn": "123-45-6789",
    "phone": "+1 (017) 555-7713", "email": "und.34@mail7.example.com", "secret": "24be64439e3e49cf46b2d7c90f3602a3d0b907ff",
}


@pytest.mark.parametrize("kind", SAMPLES)
def test_pseudonyms_keep_their_format_and_can_be_undone(kind):
    value = SAMPLES[kind]
    text = f"see {value}, ok"
    new, counts = pii.pseudonymise(text, b"k")
    assert counts == {kind: 1} and value not in new and len(new) == len(text) or kind == "ip"
    again, same = pii.pseudonymise(new, b"k")
    assert same == {kind: 1}, "a pseudonym validates like its original"
    assert pii.pseudonymise(new, b"k", back=True)[0] == text
    assert pii.pseudonymise(text, b"k")[0] == new and pii.pseudonymise(text, b"other")[0] != new
    assert again != text


BESIDE = {
    "card": ("4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "3782 822463 10005", "378282246310005"),
    "iban": ("ES9121000418450200051332", "AT611904300234573201", "PL61109010140000071219812874", "SE45 5000 0000 0583 9825 7466", "DE89 3704 0044 0532 0130 00"),
    "phone": ("+491701234567", "+49 170 1234567", "+49 170 123 4567", "+1 555 123 4567", "+14155552671"),
}


@pytest.mark.parametrize("kind", BESIDE)
def test_values_are_found_beside_numbers_and_capitals(kind):
    r = random.Random(2)
    around = ["", "7", "12/27", "123", "2024", "BIC", "EUR", "AB12", "A", "order 7", "1234 5678"]
    for value in BESIDE[kind]:
        for left in around:
            if kind == "phone" and left[-1:].isdigit():
                left += ":"
            for right in around:
                for key in (b"k", b"%d" % r.randrange(10**6)):
                    text = f"{left} {value} {right}"
                    new, counts = pii.pseudonymise(text, key)
                    assert counts == {kind: 1} and value not in new, text
                    if kind != "phone" or value != "+49 170 123 4567" or right not in ("7", "123", "12/27"):  # a group more has room in a German number
                        assert new.startswith(left) and new.endswith(right), (text, new)
                    assert pii.pseudonymise(new, key, back=True)[0] == text


def test_invalid_values_stay():
    for text in ("4111 1111 1111 1112", "300.1.1.1", "2023-02-29", "666-12-1234", "plain words", ""):
        assert pii.pseudonymise(text, b"k") == (text, {})


def test_permutation_is_one_to_one():
    for size in (2, 3, 10, 97, 1000):
        out = [pii.permuted(x, size, b"k", "t") for x in range(size)]
        assert sorted(out) == list(range(size)) and [pii.permuted(y, size, b"k", "t", True) for y in out] == list(range(size))


def test_notations_of_a_value_stay_linked():
    digits = lambda t: "".join(c for c in t if c.isdigit())
    phones = ["(017) 555-7713", "017-555-7713", "017.555.7713"]
    new = [pii.pseudonymise(f"call {t} now", b"k")[0][5:-4] for t in phones]
    assert len(set(map(digits, new))) == 1 and digits(new[0]) != "0175557713" and [len(x) for x in new] == [len(x) for x in phones]
    days = ["2024-02-29", "2024/2/29", "29.02.2024", "02/29/2024", "29/2/2024", "Feb 29, 2024", "29 February 2024", "FEB 29th 2024"]
    seen = set()
    for d in days:
        out, counts = pii.pseudonymise(f"on {d}.", b"k")
        assert counts == {"date": 1} and d not in out and pii.pseudonymise(out, b"k", back=True)[0] == f"on {d}."
        n = [int(x) for x in re.findall(r"\d+", out)]
        word = re.search("[A-Za-z]{3,}", out[3:])
        month = next(k for k, m in enumerate(pii.MONTHS, 1) if m[:3] == word[0][:3].lower()) if word else None
        year, rest = max(n), sorted(set(n) - {max(n)})
        seen.add((year, tuple(sorted({*rest, month} - {None}))))
    assert len(seen) == 1
    for text in ("May 5, 2024", "1 may 1999", "March 12, 2001", "30/02/2024", "Feb 30, 2024", "2024-13-01", "Octopus 12, 2024"):
        out, counts = pii.pseudonymise(text, b"k")
        assert pii.pseudonymise(out, b"k", back=True)[0] == text and bool(counts) == text.lower().startswith(("may", "1 may", "march"))


def test_cards_need_an_issuer():
    for d in ("4111111111111111", "5555555555554444", "378282246310005", "6011111111111117", "3530111333300000", "30569309025904"):
        new, counts = pii.pseudonymise(d, b"k")
        assert counts == {"card": 1} and new[:1] == d[:1] and pii._is_card(new) and pii.pseudonymise(new, b"k", back=True)[0] == d
    body = "081099284724940"
    assert pii.pseudonymise(body + str(pii.luhn(body)), b"k")[1] == {}, "no network has numbers that start with 0"


def test_many_values_take_linear_time():
    def seconds(n):
        text = " ".join(f"on 2024-{k % 12 + 1:02d}-{k % 28 + 1:02d} from 10.{k % 250}.{k % 7}.1" for k in range(n))
        at = time.perf_counter()
        assert pii.pseudonymise(text, b"k")[1] == {"date": n, "ip": n}
        return time.perf_counter() - at

    seconds(100)
    assert seconds(8000) < 6 * seconds(2000)


def brute_pseudonyms(text, key):
    """Tries every span of the text at every place, longest first, kind by kind, with the validators alone."""
    taken, out = [False] * len(text), []
    kinds = [("ip", pii._ip, r"(?:\d{1,3}\.){3}\d{1,3}"), ("date", pii._date, r"\d{4}-\d\d-\d\d"), ("ssn", pii._ssn, r"\d{3}-\d\d-\d{4}"), ("card", pii._card, r"\d{13,19}")]
    for kind, change, shape in kinds:
        at = 0
        while at < len(text):
            for end in range(min(len(text), at + 40), at, -1):
                span = text[at:end]
                beside = text[at - 1 : at], text[end : end + 1]
                if re.fullmatch(shape, span) and not any(c.isdigit() or c in "-." and c for c in beside) and not any(taken[at:end]) and (new := change(span, key, False)):
                    out.append((at, end, new))
                    taken[at:end] = [True] * (end - at)
                    break
            at += 1
    for a, b, new in sorted(out, reverse=True):
        text = text[:a] + new + text[b:]
    return text, len(out)


def test_whole_query_matches_brute_force(spark):
    r, rows = random.Random(8), []
    card = lambda: (b := "4" + "".join(str(r.randrange(10)) for _ in range(14))) + str(pii.luhn(b))
    for i in range(60):
        parts = words(r.randrange(5, 30), i)
        for _ in range(r.randrange(0, 5)):
            value = r.choice([card(), f"{r.randrange(300)}.{r.randrange(300)}.{r.randrange(256)}.{r.randrange(256)}", f"20{r.randrange(10, 30)}-{r.randrange(1, 14):02d}-{r.randrange(1, 32):02d}", f"{r.randrange(1000):03d}-{r.randrange(100):02d}-{r.randrange(10000):04d}", str(10**15 + r.randrange(10**15))])
            parts.insert(r.randrange(len(parts)), value)
        rows.append((i, " ".join(parts)))
    key = hashlib.sha256(b"k").digest()
    got = {x.doc_id: (x.text, x.n_replaced) for x in pii.pseudonymise_table(docs(spark, rows), "k").collect()}
    assert got == {i: brute_pseudonyms(t, key) for i, t in rows} and sum(n for _, n in got.values()) > 40


def test_pseudonym_table(spark):
    rows = docs(spark, [(1, f"a {SAMPLES['card']}"), (2, f"b {SAMPLES['card']}"), (3, None), (None, ""), (1, "x " * 50_000 + SAMPLES["ip"])])
    got = pii.pseudonymise_table(rows.withColumn("kinds", F.lit(0)), "k").collect()
    assert got[0].text[2:] == got[1].text[2:] and got[2].text is None and got[3].text == "" and [r.n_replaced for r in got] == [1, 1, 0, 0, 1]
    assert pii.pseudonymise_table(rows.limit(0), "k").count() == 0


# ---- 3


def brute_links(vectors, least):
    ids = sorted(vectors)
    m = np.array([vectors[i] for i in ids], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near = (m @ m.T >= least) & ~np.eye(len(ids), dtype=bool)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(near), strict=True):
            x = min(label[ids[a]], label[ids[b]])
            if label[ids[a]] != x or label[ids[b]] != x:
                label[ids[a]] = label[ids[b]] = x
                changed = True
    return {i: (int(near[k].sum()), label[i]) for k, i in enumerate(ids)}


@pytest.mark.parametrize("block, stripe", [(37, 512), (90, 16), (16384, 64)])
def test_vector_links_match_brute_force(spark, ws, monkeypatch, block, stripe):
    monkeypatch.setattr(vector_join, "BLOCK", block)
    monkeypatch.setattr(vector_join, "STRIPE", stripe)
    r = np.random.default_rng(1)
    centres = r.normal(size=(9, 12))
    vectors = {i: (centres[0 if i < 150 else r.integers(9)] + r.normal(scale=0.35, size=12)).astype(np.float32).tolist() for i in range(400)}
    vectors[401] = vectors[3]
    rows = [(i, v, 1) for i, v in vectors.items()] + [(900, None, 1), (901, [0.0] * 12, 1), (902, [float("nan")] * 12, 1), (903, [], 1), (904, [None, 1.0], 1), (None, vectors[3], 1), (905, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"_id": F.lit(1), "_n": F.lit(1), "kept": F.lit(1)})
    out = vector_join.vector_links(ws, df)
    got = {x.vec_id: (x.n_links, x.component_id) for x in out.collect()}
    want = brute_links(vectors, 0.9)
    assert {i: got[i] for i in want} == want and sum(n for n, _ in want.values()) > 100
    assert all(got[i] == (0, i) for i in (900, 901, 902, 903, 904, 905)) and got[None] == (0, None)
    if block == 37:
        named = vector_join.vector_links(Workspace(spark, "s"), df.withColumn("vec_id", F.format_string("v%03d", "vec_id")).filter("vec_id <> 'vnull'"))
        assert {x.vec_id: (x.n_links, x.component_id) for x in named.collect()} == {f"v{i:03d}": (n, f"v{c:03d}") for i, (n, c) in got.items() if i is not None}
    empty = vector_join.vector_links(Workspace(spark, "e"), out.select("vec_id", F.array().cast("array<float>").alias("embedding")).limit(0))
    assert empty.count() == 0


def test_bounds_prune_where_vectors_cluster_and_cost_nothing_where_they_do_not(spark, ws, monkeypatch):
    monkeypatch.setattr(vector_join, "BLOCK", 100)
    r = np.random.default_rng(2)
    centres = r.normal(size=(40, 24))
    near = [(i, 24, 1, (centres[i % 40] + r.normal(scale=0.12, size=24)).astype(np.float32).tobytes()) for i in range(2000)]
    apart = [(i, 24, 1, r.normal(size=24).astype(np.float32).tobytes()) for i in range(2000)]
    schema = "_rep long, _dim int, _n long, _raw binary"
    some = vector_join.pruned(vector_join.placed(ws, spark.createDataFrame(near, schema), 0.9))
    none = vector_join.pruned(vector_join.placed(Workspace(spark, "n"), spark.createDataFrame(apart, schema), 0.9))
    assert some["vectors"] == 2000 and some["compared"] < 0.15 and none["compared"] <= 1.0001 and none["copies"] < 3


# ---- 4


def test_url_lists(spark, ws):
    e = [("a", "domain", "Bad.org", "add", "2024-01-01"), ("a", "domain", "bad.org", "remove", "2024-02-01"), ("a", "domain", "bad.org", "add", "2024-01-15"), ("b", "prefix", "ok.org/x", "add", "2024-01-01"), ("b", "prefix", None, "add", "2024-01-01"), ("c", "domain", "gone.org", "remove", "2024-01-01")]
    entries = spark.createDataFrame(e, "list string, kind string, key string, action string, at string").withColumn("at", F.to_timestamp_ntz("at"))
    c = [(1, "http://www.bad.org/p", "2024-01-20"), (2, "http://bad.org", "2024-02-01"), (3, "http://notbad.org/", "2024-01-20"), (4, "https://u@OK.org:80/x/y?q", "2024-01-20"), (5, "https://ok.org/xy", "2024-01-20"), (6, None, "2024-01-20"), (7, "http://bad.org/", None), (None, "http://bad.org/", "2024-01-20"), (1, "http://www.bad.org/p", "2024-01-20"), (8, "http://gone.org/", "2024-03-01")]
    captures = spark.createDataFrame(c, "page_id long, url string, t string").withColumn("fetched_at", F.to_timestamp_ntz("t")).withColumn("lists", F.lit(1))
    got = sorted((r.page_id or 0, r.blocked, r.lists) for r in url_lists.filter_urls(ws, captures, entries).collect())
    assert got == [(0, True, "a"), (1, True, "a"), (1, True, "a"), (2, False, ""), (3, False, ""), (4, True, "b"), (5, False, ""), (6, False, ""), (7, False, ""), (8, False, "")]
    assert url_lists.filter_urls(Workspace(spark, "e"), captures, entries.limit(0)).filter("blocked").count() == 0


# ---- 5


def test_budgets_share_shortages_among_siblings_first():
    supply = {("a", "x", "1"): 10, ("a", "x", "2"): 1000, ("a", "y", "3"): 1000, ("b", "z", "4"): 1000}
    got = mixing.budgets(supply, 400, {(): {"a": 1.0, "b": 1.0}}, 1)
    assert got[("a", "x", "1")] == 10 and got[("a", "x", "2")] == 90 and got[("a", "y", "3")] == 100 and got[("b", "z", "4")] == 200
    got = mixing.budgets({("a", "x", "1"): 10, ("b", "z", "4"): 1000}, 400, {}, 2)
    assert got == {("a", "x", "1"): 20, ("b", "z", "4"): 380}
    assert sum(mixing.budgets(supply, 10**9, {}, 3).values()) == 3 * sum(supply.values())
    assert mixing.budgets({}, 10, {}, 1) == {}
    assert mixing.budgets({("a", "x", "1"): 10, ("b", "z", "4"): 10}, 10, {(): {"a": 0.0}}, 1) == {("a", "x", "1"): 0, ("b", "z", "4"): 10}


def test_mixing_matches_brute_force(spark, ws):
    import hashlib

    rows = [(i, " ".join(words(5 + i % 17, i)), ["en", "de", None][i % 3], f"src{i % 5}", 0) for i in range(120)] + [(500, None, "en", "src1", 0), (501, "  ", "en", "src1", 0), (None, "some words here", "en", None, 0)]
    df = spark.createDataFrame(rows, DOCS)
    clashing = df.withColumns({n: F.lit(1) for n in ("domain", "_id", "_leaf", "_cid", "_tokens", "_in")})
    mixed = mixing.mix(ws, clashing, 0.7, 2)
    assert set(mixed.columns) == {*clashing.columns, "n_tokens", "n_copies"} and mixed.filter("_id <> 1 or _leaf <> 1").count() == 0
    got = {r.doc_id: r.n_copies for r in mixed.collect()}
    leaves = {}
    for i, t, lang, source, _ in rows:
        if t and t.split():
            domain = ("web", "books", "code", "forums")[int(source[3:]) % 4 if source else 0]
            leaves.setdefault((domain, lang or "", source or ""), []).append(("" if i is None else str(i), len(t.split()), i))
    supply = {k: sum(n for _, n, _ in v) for k, v in leaves.items()}
    given = mixing.budgets(supply, 0.7 * sum(supply.values()), mixing.WEIGHTS, 2)
    want = {}
    for k, v in leaves.items():
        whole, rest, at = int(given[k] // supply[k]), given[k] - given[k] // supply[k] * supply[k], 0
        for _, n, i in sorted(v, key=lambda x: (hashlib.md5(f"mix-1|{whole}|{x[0]}".encode()).hexdigest(), x[0])):
            if c := min(2, whole + (at < round(rest, 6))):
                want[i] = c
            at += n
    assert got == want
    assert mixing.mix(Workspace(spark, "e"), df.limit(0)).count() == 0
    twice = docs(spark, [(1, "a b c"), (1, "a b c"), (2, "w " * 200_000), (3, "d")])
    assert sorted((r.doc_id, r.n_tokens) for r in mixing.mix(Workspace(spark, "r"), twice, 1.0, 1).collect()) == [(1, 3), (1, 3), (2, 200_000), (3, 1)]


# ---- 6


def test_classifier_learns_from_passages_and_never_from_held_out_labels(spark):
    r = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        good = r.random() < 0.6
        w = words(r.randrange(20, 200), i)
        rows.append((i, " ".join(w if good else [x + "###" for x in w])))
        labels.append((i, int(good), 0))
    labels.append((0, None, 0))
    df, y = docs(spark, [*rows, (900, None), (901, ""), (None, "plain text")]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in quality.score_quality(df, quality.train(df, y)).collect()}
    assert np.mean([got[i].predicted == q for i, q, _ in labels[:400] if got[i].held_out]) > 0.97
    assert all(0 <= x.score <= 1 for x in got.values()) and got[900].score == got[901].score and got[None].held_out is False
    flipped = y.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {x.doc_id: x.score for x in quality.score_quality(df, quality.train(df, flipped)).collect()}
    assert all(abs(again[i] - x.score) < 1e-9 for i, x in got.items())
    assert quality.train(df, y.limit(0)) == 0.5
    assert quality.score_quality(df, 0.5).count() == 403
    assert next(quality.encode(["a " * 20_000])).shape[0] == -(-20_000 // quality.PASSAGE_WORDS)
    again = df.unionByName(df).withColumns({"_id": F.lit(1), "_y": F.lit(1), "score": F.lit(1), "_text": F.lit(1)})
    twice = quality.score_quality(again, quality.train(again, y)).collect()
    assert len(twice) == 806 and all(abs(x.score - got[x.doc_id].score) < 1e-9 for x in twice), "repeated rows count once"


def test_encoding_does_not_depend_on_what_lies_beside(monkeypatch):
    texts = [" ".join(words(n, n)) for n in (1, 47, 48, 49, 200, 1000)] + ["", None, "a\u2003b  c\n", "x"]
    table = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.VECTOR)).astype(np.float32)
    alone = [next(quality.encode([t], table)) for t in texts]
    together = list(quality.encode(texts, table))
    for a, shares in zip(alone, quality.encode(texts), strict=True):
        assert np.allclose(a[:, quality.STATISTICS :], shares[:, quality.STATISTICS :] @ table, atol=1e-5)
    monkeypatch.setattr(quality, "PIECE", 2)
    pieces = list(quality.encode(texts, table))
    assert all(len(a) == max(1, -(-len((t or "").split()) // 48)) for a, t in zip(alone, texts, strict=True))
    assert all(np.array_equal(a, b) and np.array_equal(a, c) for a, b, c in zip(alone, together, pieces, strict=True))


def test_classifier_tells_word_order_where_characters_are_alike(spark):
    """Good and bad texts hold the same words as often; only in good ones they follow a grammar."""
    r, rows, labels = random.Random(6), [], []
    vocabulary = [f"{a}{b}" for a in "bdfgkl" for b in ("aro", "eni", "otu", "iva", "uso")]
    follows = {w: r.sample(vocabulary, 2) for w in vocabulary}
    for i in range(700):
        w = [r.choice(vocabulary)]
        while len(w) < 150:
            w.append(r.choice(follows[w[-1]]))
        good = i % 2
        if not good:
            r.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, good, 0))
    df, y = docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in quality.score_quality(df, quality.train(df, y)).collect()}
    assert np.mean([got[i].predicted == q for i, q, _ in labels if got[i].held_out]) > 0.95


# ---- 7


def test_shards_are_even_gapless_and_keep_groups(spark, ws):
    texts = [(i, f"copy {i % 20}" if i < 100 else f"single {i}") for i in range(1000)] + [(None, None), (None, None), (5, "copy 5"), (5, "copy 5")]
    clashing = docs(spark, texts).withColumns({n: F.lit("x") for n in ("shard", "_row", "_id", "_key", "_group", "_shard", "_slot", "_in", "before")})
    kept = sharding.shard_documents(Workspace(spark, "c"), clashing)
    assert kept.columns == [*(c for c in clashing.columns if c != "shard"), "shard", "slot"] and kept.filter("_row = 'x' and before = 'x'").count() == len(texts)
    out = sharding.assignments(ws, clashing).collect()
    assert len(out) == len(texts)
    shards = {}
    for r in out:
        shards.setdefault(r.shard, []).append(r.slot)
    assert set(shards) == set(range(16)) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    groups = {}
    for r in out:
        if r.doc_id is not None and r.doc_id < 100:
            groups.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) - 1 for s in groups.values()) <= 2
    assert {(r.size, r.text_crc32) for r in out if r.doc_id is None} == {(1, 0)}
    where = {}
    for r in out:
        where.setdefault((r.size, r.text_crc32), []).append(r.shard)
    assert all(r.n_cut == sum(s != r.shard for s in where[r.size, r.text_crc32]) for r in out)
    assert sharding.assignments(Workspace(spark, "e"), docs(spark, texts).limit(0)).count() == 0


def test_one_row_repeated_very_often_and_a_very_long_text(spark, ws):
    rows = docs(spark, [(1, "same")] * 3000 + [(2, "x " * 300_000), (3, "y")])
    out = sharding.assignments(ws, rows).collect()
    sizes = np.bincount([r.shard for r in out], minlength=16)
    assert len(out) == 3002 and sizes.max() - sizes.min() <= 1 and len({(r.shard, r.slot) for r in out}) == 3002


def test_a_group_larger_than_a_shard_is_split(spark, ws):
    rows = spark.range(300).select(F.col("id").alias("_row"), F.when(F.col("id") < 120, "g").alias("_group"))
    got = sharding.shard_rows(ws, rows, 6)
    counts = [r["count"] for r in got.groupBy("_shard").count().collect()]
    assert counts == [50] * 6 and got.filter("_row < 120").select("_shard").distinct().count() <= 5


@pytest.mark.parametrize("sizes, n, shards", [([120], 300, 6), ([533], 1600, 16), ([100, 100, 100], 300, 6), ([70, 45, 45, 45, 30, 30] + [3] * 11, 303, 6), ([40] * 7, 300, 6), ([12], 12, 5), ([2], 3, 6)])
def test_groups_take_few_shards(spark, ws, sizes, n, shards):
    groups = [g for g, k in enumerate(sizes) for _ in range(k)]
    rows = spark.createDataFrame([(f"r{i}", f"g{groups[i]}" if i < len(groups) else None) for i in range(n)], "_row string, _group string")
    got = {r._row: (r._shard, r._slot) for r in sharding.shard_rows(ws, rows, shards).collect()}
    assert len(got) == n and set(got.values()) == {(s, x) for s, q in enumerate(sharding.quotas(n, shards)) for x in range(q)}
    held = [len({got[f"r{i}"][0] for i, h in enumerate(groups) if h == g}) for g in range(len(sizes))]
    least = [-(-k // max(1, n // shards)) for k in sizes]
    assert all(h <= x + 1 for h, x in zip(held, least, strict=True)) and sum(held) - len(held) <= shards - 1


# ---- 8


def test_line_windows(spark, ws):
    a = "l1\nl2\nl3\nl4\nl5"
    texts = [(1, a), (2, "x\n" + a + "\ny"), (3, "l1\nl2"), (4, None), (5, ""), (6, a + "\n" + a), (None, a), (7, "\n\n\n"), (8, "\n\n\n"), (9, a), (9, a)]
    got = {}
    clashing = docs(spark, texts).withColumns({n: F.lit("clash") for n in ("_id", "_starts", "_lines", "_gone", "_in", "n_lines")})
    out = line_dedup.dedup_lines(ws, clashing)
    assert set(out.columns) == {*clashing.columns, "n_removed"} and out.filter("_lines = 'clash' and _id = 'clash'").count() == len(texts)
    for r in out.collect():
        got[r.doc_id] = (r.n_lines, r.n_removed, r.text)
    assert got[1] == (5, 0, a) and got[2] == (7, 5, "x\ny") and got[3] == (2, 0, "l1\nl2") and got[4] == (0, 0, None) and got[5] == (1, 0, "")
    assert got[6] == (10, 10, "") and got[None][2] == a and got[7] == got[8] == (4, 0, "\n\n\n") and got[9] == (5, 5, "")
    assert line_dedup.dedup_lines(Workspace(spark, "e"), docs(spark, texts).limit(0)).count() == 0
    long = "\n".join(f"line {i}" for i in range(40_000))
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(Workspace(spark, "l"), docs(spark, [(1, long), (2, "new\n" + long)])).collect()}
    assert got == {1: (40_000, 0), 2: (40_001, 40_000)}


# ---- 9


def brute_groups(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        k = min(4, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
    label = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("block, few", [(7, 8), (7, 0), (3, 2), (512, 8)])
def test_near_duplicates_match_brute_force(spark, ws, monkeypatch, block, few):
    monkeypatch.setattr(near_dup, "BLOCK_TEXTS", block)
    monkeypatch.setattr(near_dup, "CLUSTER_BLOCKS", few)
    r, texts = random.Random(9), []
    for g in range(25):
        base = words(r.randrange(30, 160), g)
        for k in range(r.randrange(1, 9)):
            w = list(base)
            for _ in range(r.randrange(0, 7)):
                w[r.randrange(len(w))] = f"z{r.randrange(10**6)}"
            texts.append((g * 100 + k, " ".join(w)))
            base = w if g % 3 == 0 else base  # chains, whose ends aren't alike
    texts += [(9000, None), (9001, ""), (9002, "A b"), (9003, "a  B"), (9004, "a b c"), (9005, "  x"), (9006, " x")]
    df = docs(spark, [*texts, (None, "a b c"), (9004, "a b c")]).withColumns({n: F.lit(1) for n in ("kept", "_id", "_gone", "_n")})
    out = near_dup.near_duplicates(ws, df).collect()
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in out if x.doc_id is not None}
    assert got == brute_groups(texts) and len(out) == len(texts) + 2
    assert [(x.component_id, x.kept) for x in out if x.doc_id is None] == [(None, True)]
    if block == 512:
        left = near_dup.keep_one(Workspace(spark, "k"), df)
        assert left.columns == df.columns and {x.doc_id for x in left.collect()} == {i for i, (_, c) in got.items() if i == c} | {None}
        named = near_dup.near_duplicates(Workspace(spark, "s"), df.filter("doc_id is not null").withColumn("doc_id", F.format_string("d%05d", "doc_id"))).collect()
        assert {x.doc_id: (x.n_shingles, x.component_id) for x in named} == {f"d{i:05d}": (n, f"d{c:05d}") for i, (n, c) in got.items()}
        assert near_dup.near_duplicates(Workspace(spark, "e"), df.limit(0)).count() == 0


def test_sets_that_share_an_id_and_a_very_long_text(spark, ws):
    a, b, long = " ".join(words(60, 1)), " ".join(words(60, 2)), " ".join(words(120_000, 3, 10**6))
    rows = [(5, a), (5, b), (7, a + " x"), (8, b + " y"), (3, b + " z"), (9, long), (10, long + " end"), (2, None)]
    got = sorted((x.doc_id, x.component_id, x.kept) for x in near_dup.near_duplicates(ws, docs(spark, rows)).collect())
    assert got == [(2, 2, True), (3, 3, True), (5, 3, False), (5, 5, True), (7, 5, False), (8, 3, False), (9, 9, True), (10, 9, False)]
    left = near_dup.keep_one(Workspace(spark, "k"), docs(spark, rows))
    assert sorted((r.doc_id, r.text) for r in left.filter("doc_id <> 2").collect()) == [(3, b + " z"), (5, a), (9, long)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_near_duplicates_match_brute_force_on_whole_table(spark, ws):
    """All pairs of different sets that share a shingle at all, counted by shingle."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    sets, first = {}, {}
    for i, t in sorted(rows):
        w = (t or "").encode().lower().split()
        k = min(4, len(w))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset()
        first.setdefault(sets[i], i)
    where, both = {}, {}
    for s, i in first.items():
        for g in s:
            for j in where.setdefault(g, []):
                both[j, i] = both.get((j, i), 0) + 1
            where[g].append(i)
    label = {i: first[s] if s else i for i, s in sets.items()}
    links = [p for p, n in both.items() if 100 * n >= 80 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    root = {i: i for i in first.values()}
    for _ in range(len(links) + 1):
        changed = False
        for x, y in links:
            if root[x] != root[y]:
                root[x] = root[y] = min(root[x], root[y])
                changed = True
        if not changed:
            break
    want = {i: (len(s), root[label[i]] if s else i) for i, s in sets.items()}
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dup.near_duplicates(ws, docs(spark, rows)).collect()}
    assert got == want and len(links) > 3


def test_sizes_exactly_at_the_threshold_link(spark, ws):
    n = np.arange(1, 2001, dtype=float)
    same = np.zeros((len(n), near_dup.REGISTERS), np.int16)
    assert near_dup.likely(same, same, 4 * n, 5 * n)[0].all() and near_dup.likely(same, same, 5 * n, 4 * n)[0].all()
    assert not near_dup.likely(same, same, 4 * n - 1, 5 * n)[0].any()
    texts = []
    for g in range(12):
        w = [f"g{g}x{k}" for k in range(53)]
        texts += [(g * 10 + g % 2, " ".join(w)), (g * 10 + 1 - g % 2, " ".join(w[:43])), (g * 10 + 2, " ".join(w[:42]))]  # 50, 40 and 39 shingles
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dup.near_duplicates(ws, docs(spark, texts)).collect()}
    assert got == brute_groups(texts) and all(got[g * 10 + 1][1] == g * 10 for g in range(12))


def test_sketches_merge_and_estimate():
    a, b = near_dup.shingle_set(" ".join(words(900, 1))), near_dup.shingle_set(" ".join(words(900, 2)))
    both = np.unique(np.concatenate([a, b]))
    assert (np.maximum(near_dup.sketch(a), near_dup.sketch(b)) == near_dup.sketch(both)).all()
    part = both[: int(0.85 * len(both))]
    s = [near_dup.sketch(x)[None, :] for x in (a, b, both, part)]
    n = [np.array([len(x)], float) for x in (a, b, both, part)]
    assert near_dup.likely(s[2], s[3], n[2], n[3])[0][0] and not near_dup.likely(s[0], s[1], n[0], n[1])[0][0]
    assert abs(near_dup.likely(s[2], s[3], n[2], n[3])[1][0] - 0.85) < 0.12


# ---- 10


def test_contamination_matches_brute_force(spark, ws):
    r = random.Random(4)
    items = [(i, " ".join(words(r.choice([2, 4, 6, 30, 60]), 1000 + i, 300))) for i in range(30)] + [(50, None), (51, ""), (52, "--- !!"), (None, "a b c d e f")]
    texts = []
    for i in range(80):
        w = words(150, i, 300)
        if i % 2:
            q = items[r.randrange(30)][1].split()
            if i % 4 == 1 and len(q) > 10:
                q[len(q) // 2] = "changed"
            w[50:50] = q
        texts.append((i, " ".join(w) if i % 3 else ",  ".join(w).upper()))
    texts += [(900, None), (901, ""), (None, items[0][1])]
    got = {(x.doc_id, x.item_id): (x.n_shared, x.n_item) for x in decontaminate.contaminated(ws, docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()}

    def grams(t, k):
        w = "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
        return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}, len(w)

    want = {}
    for q, t in items[:30]:
        k = min(5, grams(t, 1)[1])
        s = grams(t, k)[0]
        for i, x in texts[:-1]:
            n = len(s & grams(x, k)[0])
            if n * 100 >= 80 * len(s):
                want[i, q] = (n, len(s))
    assert got == want and want
    none = spark.createDataFrame([(1, None)], "item_id long, text string")
    assert decontaminate.contaminated(Workspace(spark, "e"), docs(spark, texts), none).count() == 0
    assert decontaminate.decontaminate(Workspace(spark, "f"), docs(spark, texts), spark.createDataFrame(items, "item_id long, text string")).count() == len(texts) - len({i for i, _ in want})


def test_a_size_partition_has_a_bound_of_its_own(spark, ws):
    """Small items, whose sketches reach high, don't widen what documents send to large ones, and the other way round."""
    def bounds(name, sizes):
        items = spark.createDataFrame([(i, " ".join(f"s{n}x{i}y{j}" for j in range(n + 4))) for i, n in enumerate(sizes)], "item_id long, text string")
        w = Workspace(spark, name)
        return {(p.k, p.size_class): (p.top, p.need) for p in decontaminate.sketches(w, decontaminate.item_sets(w, items, "item_id", "text", 5), 5, 80)[1]}

    small, large = [2] * 20, [40] * 20
    alone, both = bounds("a", large), bounds("b", large + small)
    assert set(alone) == {(5, 5)} and set(both) == {(5, 1), (5, 5)}
    assert both[5, 5][1] == 32 and both[5, 1][1] == 2
    # of 40 shingles the 9 smallest hashes make the sketch, so the bound lies far below that of items of two shingles
    assert both[5, 5] == alone[5, 5] and both[5, 5][0] < 2**62 < both[5, 1][0]
    docs_ = spark.createDataFrame([(i, 0, [f"d{i}x{j}" for j in range(60)]) for i in range(40)] + [(99, 0, ["a"] * 20)], "_id long, _version long, _w array<string>")
    parts = [decontaminate.Partition(5, c, top, need) for (_, c), (top, need) in both.items()]
    sent = {(r._class, r._id == 99): r["count"] for r in decontaminate.probes(docs_, parts).withColumn("x", F.lit(1)).groupBy("_class", "_id").count().collect()}
    assert not any(c == 5 and short for c, short in sent), "a document smaller than an item needs asks nothing"


def test_repeated_ids_texts_and_clashing_names(spark, ws):
    item = " ".join(words(30, 1))
    items = spark.createDataFrame([(1, item, 0), (2, item, 0), (1, "other words entirely " * 4, 0), (3, " ".join(words(30, 2)), 0)], "item_id long, text string, _item int")
    rows = [("a", "x " + item), ("a", "nothing here"), ("b", "nothing here"), ("c", item * 1 + " y" * 50_000), (None, item)]
    df = spark.createDataFrame(rows, "doc_id string, text string").withColumns({n: F.lit(7) for n in ("_hit", "_id", "_k", "_version", "item_id", "n_item", "w0")})
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_item) for r in decontaminate.contaminated(ws, df, items).collect()}
    assert got == {(d, i): (26, 26) for d in "ac" for i in (1, 2)}
    left = decontaminate.decontaminate(Workspace(spark, "l"), df, items)
    assert left.columns == df.columns and sorted(str(r.doc_id) for r in left.collect()) == ["None", "b"]
    none = decontaminate.contaminated(Workspace(spark, "n"), df, items.limit(0))
    assert none.count() == 0 and none.schema["doc_id"].dataType.simpleString() == "string"
