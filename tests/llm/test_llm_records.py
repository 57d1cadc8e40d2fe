"""Mixing, personal data, URLs, pages, vectors and token counts."""

from __future__ import annotations

import html
import random
import re
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import smallest_reachable
from qaloom.llm import extraction, mixing, pii, token_counts, urls, vectors

# --- mixing ----------------------------------------------------------------------


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = docs.join(labels, "doc_id").select("text", mixing.domain_of(labels).alias("d")).orderBy(F.xxhash64("text"))
    rows = [(r["text"], list(mixing.TARGETS).index(r["d"])) for r in rows.collect()]
    cut = 2 * len(rows) // 3
    weights = mixing.train([t for t, _ in rows[:cut]], np.array([d for _, d in rows[:cut]]), 3)
    held = rows[cut:]
    p = mixing.posteriors(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(held)], "doc_id long, text string"), weights, 3)
    right = sum(np.argmax(r["p"]) == held[r["id"]][1] for r in p.collect())
    assert right / len(held) > 0.82  # the largest class has about three quarters


def plain_rates(tokens, p, want, rounds=2000):
    """Projected gradient on whole arrays."""
    metric = np.linalg.pinv((tokens[:, None] * p).T @ p, rcond=1e-9, hermitian=True)
    r = np.ones(len(tokens))
    for _ in range(rounds):
        r = np.maximum(0, r - p @ (metric @ ((r * tokens) @ p - want)))
    return r


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 500)
    tokens = rng.integers(0, 900, 500).astype(float)
    df = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(tokens, p))], "id long, n_tokens long, p array<double>")
    targets = {"good": 0.7, "poor": 0.2, "toxic": 0.1}
    moves = mixing.fit_rates(df, targets)
    found = {r["id"]: r["rate"] for r in df.select("id", mixing.rate_of(F.col("p"), moves).alias("rate")).collect()}
    rates = np.array([found[i] for i in range(500)])
    want = np.array([0.7, 0.2, 0.1]) * (tokens @ p)[0] / 0.7
    assert (rates >= 0).all() and np.allclose((rates * tokens) @ p, want, rtol=1e-4)
    assert np.allclose(rates, plain_rates(tokens, p, want), atol=1e-3)


def test_mixing_odd_rows(spark, sf_dir, odd_docs, no_docs):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for given in (labels, labels.limit(0), spark.createDataFrame([(None, None, None)], labels.schema)):
        assert mixing.mixing_rates(odd_docs, given).count() == odd_docs.count()
        assert mixing.mixing_rates(no_docs, given).count() == 0
        assert mixing.mix(odd_docs, given).columns == odd_docs.columns
        assert mixing.mix(no_docs, given).count() == 0


def test_mix_takes_rows_as_often_as_their_rate(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rated = mixing.mixing_rates(docs, labels)
    times = rated.select("id", mixing.copies(F.col("rate"), F.col("id")).alias("n")).where("n > 0")
    mixed = mixing.mix(docs, labels).groupBy("doc_id").agg(F.count("*").cast("int").alias("n"))
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, times.collect()))


# --- personal data ---------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            luhn = sum(d - 9 * (d > 9) for d in twice) % 10 == 0
            if (
                (kind == "ip" and any(int(x) > 255 for x in m[0].split(".")))
                or (kind == "card" and not (16 <= len(digits) <= 19 and luhn))
                or (kind == "phone" and not 8 <= len(digits) <= 15)
            ):
                continue
            out.append((kind, m.start(), m.end()))
    return out


def found_spans(df, column="base"):
    rows = pii.personal_data(df).collect()
    return sorted(((r["id"], [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in r[column]]) for r in rows), key=repr)


def test_base_spans(spark, odd_docs, no_docs):
    rng = random.Random(5)
    chars = "0123456789.@+- ()ab_é\U0001f600\n%1234567890.1.2@x.y"
    rows = [(i, "".join(rng.choice(chars) for _ in range(rng.randint(0, 120)))) for i in range(1500)]
    rows += [(5001, "1" * 5000), (5002, "a" * 50000), (5004, "a." * 3000 + "@" + "b." * 3000), (5005, "1." * 3000)]
    rows += [(5003, "a@b.c_d@e.f +1 (555) 123-4567 4111 1111 1111 1111 1.2.3.4.5.6.7.8 0001.02.255.256")]
    rows += [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_spans(df) == sorted(((i, plain_spans(t)) for i, t in rows), key=repr)
    assert found_spans(no_docs) == []


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"please mail: user{i}@example.com today, the year {i}") for i in range(12)]
    rows += [(100, "please mail: bob(at)example.com today"), (101, "please read: bob(at)example.com later")]
    rows += [(102, "the year 12345678 and (mail: carl@host), so")]
    rows += [(103, "mail: a@b.org, x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts, spans = dict(rows), dict(found_spans(df, "spans"))
    added = {(i, texts[i][s:e]) for i, found in spans.items() for k, s, e in found if (k, s, e) not in plain_spans(texts[i])}
    # the context "mail:" is sure; what it finds is an identifier in weaker contexts as well
    assert {(100, "bob(at)example.com"), (102, "carl@host")} <= added
    assert {i for i, _ in added} <= {100, 101, 102} and all("8" not in t for _, t in added)
    assert all(set(plain_spans(texts[i])) <= set(found) for i, found in spans.items())


def test_weak_contexts_find_nothing(spark):
    rows = [(i, f"the user{i}@example.com and the {i}{i}@x and the room{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_spans(df, "spans") == found_spans(df)


def plain_contexts(text):
    """``(token, start, before, after)`` of a text's candidates, in plain Python."""
    spaces = " \t\n\x0b\f\r"
    found = list(re.finditer(pii.CANDIDATE.replace("\\x0B", "\\x0b"), text))
    for k, m in enumerate(found):
        token = re.sub(pii.TAIL, "", re.sub(pii.HEAD, "", m[0]))
        lead = len(m[0]) - len(re.sub(pii.HEAD, "", m[0]))
        left = text[found[k - 1].end() if k else 0 : m.start()].strip(spaces)
        right = text[m.end() : found[k + 1].start() if k + 1 < len(found) else len(text)].strip(spaces)
        before = re.split(f"[{spaces}]", left)[-1] if left else (found[k - 1][0] if k else "")
        after = re.split(f"[{spaces}]", right)[0] if right else (found[k + 1][0] if k + 1 < len(found) else "")
        if len(token) >= pii.MIN_TOKEN:
            yield token, m.start() + lead, re.sub(pii.HEAD, "", before.lower()), re.sub(pii.TAIL, "", after.lower())


@cache
def plain_kind(token):
    return next((k for k, s, e in plain_spans(token) if (s, e) == (0, len(token))), None)


def plain_shape(token, kind):
    n, plain = len(re.findall("[0-9]", token)), not re.search("[A-Za-z]", token)
    return {
        "email": "@" in token or bool(re.search(r"(?i)[\[({]at[\])}]", token)),
        "ip": len(token) <= 45 and bool(re.fullmatch("[0-9a-fA-F]+([.:]+[0-9a-fA-F]+){3,}", token)),
        "card": n >= 12 and plain,
        "phone": 7 <= n <= 15 and plain,
    }[kind]


def plain_bootstrap(texts):
    graph = {}
    for text in texts:
        for token, _, before, after in plain_contexts(text):
            for pattern in (f"{before} _", f"_ {after}", f"{before} _ {after}"):
                graph.setdefault(pattern, set()).add(token)
    confirmed = {}
    for _ in range(pii.ROUNDS):
        now = {}
        for pattern, tokens in graph.items():
            for kind in pii.KINDS:
                good = [t for t in tokens if plain_kind(t) == kind or confirmed.get((t, kind), set()) - {pattern}]
                if len(good) >= pii.MIN_SEEDS and len(good) >= pii.MIN_CONFIDENCE * len(tokens):
                    for t in tokens:
                        if plain_kind(t) is None and plain_shape(t, kind):
                            now.setdefault((t, kind), set()).add(pattern)
        confirmed = now
    best = {}
    for (token, kind), patterns in confirmed.items():
        vote = (len(patterns), -pii.KINDS.index(kind))
        best[token] = max(best.get(token, vote), vote)
    return {t: pii.KINDS[-k] for t, (_, k) in best.items()}


def plain_personal_data(rows):
    kinds = plain_bootstrap([t or "" for _, t in rows])
    out = []
    for i, text in rows:
        base = plain_spans(text)
        added = {(kinds[t], s, s + len(t)) for t, s, _, _ in plain_contexts(text or "") if t in kinds}
        free = [a for a in added if not any(a[1] < e and s < a[2] for _, s, e in base)]
        out.append((i, sorted([*base, *free], key=lambda x: (pii.KINDS.index(x[0]), *x[1:]))))
    return sorted(out, key=repr)


def test_bootstrap_equals_plain_version(spark, odd_docs):
    rng = random.Random(8)
    made = {
        "mail": lambda n: f"u{n}@ex{n % 3}.com", "call": lambda n: f"+1 ({n:03d}) 555-{n:04d}", "card": lambda n: "4111 1111 1111 1111",
        "lax": lambda n: f"u{n}@host", "dial": lambda n: f"0{n:03d} 555 {n:04d}", "at": lambda n: f"u{n}(at)ex.com", "num": lambda n: str(n),
    }
    leads = ["mail:", "phone", "(call", "see", "the", "year", "id:"]
    likely = {"mail:": ("mail", "lax", "at"), "phone": ("call", "dial"), "(call": ("call", "dial", "card")}
    rows = []
    for i in range(400):
        words = []
        for _ in range(rng.randint(1, 8)):
            lead = rng.choice(leads)
            kind = rng.choices(likely[lead], [14, *[1] * (len(likely[lead]) - 1)])[0] if lead in likely else rng.choice(list(made))
            words += [lead, made[kind](rng.randrange(60)) + rng.choice(["", ",", ".", ")"]), rng.choice(["today", "or", "", " " * 80 + "far", "\n"])]
        rows.append((i, " ".join(words)))
    rows += [(r["doc_id"], r["text"]) for r in odd_docs.collect() if len(r["text"] or "") < 10_000]
    rows += [(900, "phone " + "1 " * 2_000 + "x"), (901, "phone " + "1.1" * 500), (902, "mail: " + "y" * 2_000 + "@z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_personal_data(rows)
    assert found_spans(df, "spans") == want
    texts = dict(rows[:400])
    added = {(k, texts[i][s:e]) for i, spans in want if i in texts for k, s, e in spans if (k, s, e) not in plain_spans(texts[i])}
    assert {k for k, _ in added} == {"email", "phone"} and any(" " in t for _, t in added)


def test_a_pattern_does_not_support_itself(spark):
    # a third of what follows the word are seeds: their share stays a third in every round
    rows = [(i, f"contact: u{i}@ex.com, or") for i in range(35)] + [(50 + i, f"contact: x{i}@y{i}, or") for i in range(65)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_spans(df, "spans") == found_spans(df)


def test_personal_data_plan_is_native(spark, sf_dir):
    plan = pii.personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- URLs ------------------------------------------------------------------------

URLS = [
    (1, "https://www.Example.ORG/es/1?x#y", "www.example.org", "/es/1", "example.org/es/", "block"),
    (2, "https://example.org/ES/1", "example.org", "/ES/1", "org/", "allow"),
    (3, "http://notexample.org/en/12", "notexample.org", "/en/12", "org/", "allow"),
    (4, "http://a.example.org/en/12", "a.example.org", "/en/12", "example.org/en/1", "block"),
    (5, "https://x.com/fr/login", "x.com", "/fr/login", "com/fr/", "allow"),
    (6, "https://x.com/de", "x.com", "/de", None, "allow"),
    (7, "https://x.com/en/login?next=/fr/", "x.com", "/en/login", None, "block"),
    (8, "https://x.com/en/loginform", "x.com", "/en/loginform", None, "allow"),
    (9, "https://m.ads-track.example.com/en/1", "m.ads-track.example.com", "/en/1", None, "block"),
    (10, "https://x.net?q=http://org/", "x.net", "", None, "allow"),
    (11, "org/", "", "", None, "allow"),
    (12, None, "", "", None, "allow"),
    (13, "https://org#/es/", "org", "", None, "allow"),
    (None, "https://x.com/de/", "x.com", "/de/", "com/de/", "block"),
    (14, "", "", "", None, "allow"),
    (14, "x://y.com/tag/a/page/3", "y.com", "/tag/a/page/3", None, "block"),
    (14, "x://y.com/tag/a/page/3", "y.com", "/tag/a/page/3", None, "block"),
]


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "h", "p") for i, u, *_ in URLS], "page_id long, url string, host string, rule string")
    found = urls.judge_urls(df, keep=["page_id", "url"]).select("page_id", "url", "host", "path", "rule", "verdict")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(URLS, key=repr)
    assert urls.judge_urls(df.limit(0), keep=["page_id"]).count() == 0


def test_each_rule_lies_under_its_rarest_token(spark):
    df = spark.createDataFrame([(f"https://a{i}.example.com/de/{i}",) for i in range(9)], "url string")
    rules = [urls.host_rule("com", "/de/", "block"), urls.pattern_rule("*x*")]
    index = urls._index(df.unionByName(spark.createDataFrame([("http://q.com/fr/",)], "url string")), rules)
    assert [row[0] for row in index] == ["de", ""]
    assert urls.pattern_rule("||ads-track.*^").tokens == ("ads", "track")
    many = [*rules, *(urls.host_rule(f"h{i}.net", "/", "block") for i in range(urls.SMALL_INDEX))]
    assert urls.judge_urls(df, many).where("rule = 'com/de/'").count() == 9


# --- pages -----------------------------------------------------------------------


def test_extraction_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["id"]: r["text"] for r in extraction.extract(pages).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*?)</article>", row["html"], re.DOTALL)[1]
        parts = [re.sub("<br>", " ", re.sub("</?b>", "", x)) for x in re.split("</?(?:h1|p)>", article)]
        parts = [" ".join(html.unescape(x).split()) for x in parts]
        assert found[row["page_id"]] == "\n\n".join(x for x in parts if x)


@pytest.fixture(scope="module")
def field():
    return extraction.train_crf(extraction.template_pages())


def test_held_out_pages(field):
    pairs = [(a, b) for blocks, labels in extraction.template_pages(200, seed=77) for a, b in zip(field.decode(blocks), labels)]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.995


def test_viterbi_finds_the_best_path(field):
    from itertools import product

    for blocks, _ in extraction.template_pages(30, seed=5):
        blocks = blocks[:7]
        scores = [field.scores(b) for b in blocks]

        def total(path):
            return sum(s[p] for s, p in zip(scores, path)) + sum(field.moves[a][b] for a, b in zip(path, path[1:]))

        assert total(field.decode(blocks)) == pytest.approx(max(map(total, product((0, 1), repeat=len(blocks)))))


def test_blocks_of_broken_markup():
    texts = lambda page: [b.text for b in extraction.leaf_blocks(page)]
    assert texts("<p>a&amp;b &lt;i&gt;<p>c<b>d<br>e") == ["a&b <i>", "cd e"]
    assert texts("<div>x<script>var a='<p>';</script>y<!-- <p> -->z</div>") == ["xyz"]
    assert texts("a < b <1 </ > c<p title='<p>'>d") == ["a < b <1 c", "d"]
    assert texts("<p>t<a href=\"x") == ["t"] and texts("") == [] and texts("<" * 5000) == ["<" * 5000]


def test_odd_pages(spark, field):
    rows = [(1, "<article><p>A text.</p></article>"), (1, "<article><p>A text.</p></article>"), (2, None), (None, ""), (3, "<p>" * 30000)]
    df = spark.createDataFrame([(i, h, "t", "r") for i, h in rows], "page_id long, html string, text string, row string")
    found = extraction.extract(df, field).select("id", "text").collect()
    assert sorted(map(tuple, found), key=repr) == sorted([(1, "A text."), (1, "A text."), (2, ""), (None, ""), (3, "")], key=repr)
    assert extraction.extract(df.limit(0)).count() == 0


# --- vectors ---------------------------------------------------------------------


def plain_vectors(rows, threshold=vectors.THRESHOLD):
    def linked(i, j):
        (_, x, a), (_, y, b) = rows[i], rows[j]
        if a is None or a != b or not x or not y or len(x) != len(y) or None in x or None in y:
            return False
        x, y = np.array(x, float), np.array(y, float)
        if not (np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any()):
            return False
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold

    n = len(rows)
    by = [[j for j in range(i + 1, n) if linked(i, j)] for i in range(n)]
    counts = [0] * n
    for i, js in enumerate(by):
        counts[i] += len(js)
        for j in js:
            counts[j] += 1
    roots = smallest_reachable(n, lambda i: by[i])
    names = {r: min((rows[i][0] for i in range(n) if roots[i] == r and rows[i][0] is not None), default=None) for r in roots}
    return sorted(((rows[i][0], counts[i], names[roots[i]], rows[i][0] == names[roots[i]]) for i in range(n)), key=repr)


@pytest.mark.parametrize("block", [vectors.BLOCK, 20])
def test_vector_groups(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + rng.normal(size=24) * rng.choice([0.02, 0.3, 1])).tolist(), i % 3 if i % 3 else 0) for i in range(240)]
    rows += [(1000 + i, centres[0].tolist(), 0) for i in range(30)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 24, [nan] + [1.0] * 23, [inf] + [1.0] * 23, [None] + [1.0] * 23, [1.0] * 3, [1e-200, 0.0, 0.0], [1e200, 0.0, 0.0]]
    rows += [(2000 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(3000, centres[0].tolist(), None), (3001, centres[0].tolist(), None), (None, centres[5].tolist(), 2), (5, [9.0, 9.1], 7), (5, [9.0, 9.1], 7), (None, [9.1, 9.0], 7), (None, [-1.0, 1.0], 7)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, node int")
    found = vectors.vector_groups(df, block=block).collect()
    assert sorted(map(tuple, found), key=repr) == plain_vectors(rows)
    assert vectors.vector_groups(df.limit(0)).count() == 0


def test_pairs_at_the_threshold():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(60, 64)), rng.normal(size=(50, 64))
    y[:30] = x[:30] + 0.3 * rng.normal(size=(30, 64))
    u, v = (m / np.linalg.norm(m, axis=1, keepdims=True) for m in (x, y))
    cos = u @ v.T
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    for threshold in (0.93, 0.5, float(cos[3, 3])):
        found = vectors.linked_pairs(u @ axes, v @ axes, x, y, threshold)
        want = np.einsum("id,jd->ij", x, y) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) >= threshold - 1e-15
        assert set(map(tuple, found)) - {(3, 3)} == set(map(tuple, np.argwhere(want))) - {(3, 3)}


# --- token counts ----------------------------------------------------------------


def test_ledger(spark, tmp_path):
    ledger = token_counts.TokenLedger(spark, str(tmp_path / "ledger"))
    changes = lambda *rows: spark.createDataFrame(rows, token_counts.CHANGE)
    totals = lambda: sorted(map(tuple, ledger.totals().collect()), key=repr)
    assert totals() == [] and ledger.current().count() == 0
    first = changes(*(("insert", i, "t1", "s" if i % 3 else None, "en", i) for i in range(10)), ("insert", 1, "t2", "s", "en", 5))
    assert ledger.apply("1", first) and not ledger.apply("1", first)
    state = [("t1", "s", "en", 6, 27), ("t1", None, "en", 4, 18), ("t2", "s", "en", 1, 5)]
    assert totals() == sorted(state, key=repr)
    # a new count, a moved document, one taken out, and changes of documents that aren't there
    second = changes(("revise", 1, "t1", "s", "en", 11), ("revise", 2, "t1", "z", "fr", 2), ("delete", 4, "t1", None, None, None),
                     ("delete", 99, "t1", None, None, None), ("revise", 50, "t2", "s", "en", None), ("delete", 1, "t2", None, None, None))
    assert ledger.apply("2", second)
    state = [("t1", "s", "en", 4, 31), ("t1", "z", "fr", 1, 2), ("t1", None, "en", 4, 18), ("t2", "s", "en", 1, 0)]
    assert totals() == sorted(state, key=repr)
    assert ledger.apply("3", changes(("insert", 7, "t1", "s", "en", 7), ("insert", 7, "t1", "s", "en", 7))) and totals() == sorted(state, key=repr)
    assert ledger.apply("4", changes()) and ledger.has("4") and totals() == sorted(state, key=repr)
    # a batch that broke off before its commit doesn't count, and is overwritten when it comes again
    broken = spark.createDataFrame([(60, "t9", "s", "en", 1, 1)], "doc_id long, tokenizer string, source string, lang string, docs long, tokens long")
    broken.write.parquet(str(tmp_path / "ledger/entries/batch=5"))
    broken.drop("doc_id").write.parquet(str(tmp_path / "ledger/totals/batch=5"))
    assert totals() == sorted(state, key=repr)
    assert ledger.apply("5", changes(("insert", 60, "t9", "s", "en", 4)))
    assert ("t9", "s", "en", 1, 4) in totals()
    with pytest.raises(Exception, match="change without a key"):
        ledger.apply("6", changes(("insert", None, "t1", "s", "en", 1)))
    assert not ledger.has("6")


def test_ledger_of_odd_documents(spark, tmp_path, odd_docs):
    ledger = token_counts.TokenLedger(spark, str(tmp_path / "ledger"))
    ledger.apply("1", token_counts.counted(odd_docs.where("doc_id IS NOT NULL"), "insert", "words-1"))
    assert {(r["doc_id"], r["tokens"]) for r in ledger.current().collect()} == {
        (1, 6), (2, 6), (3, 0), (4, 0), (5, 0), (6, 40_000), (7, 2), (8, 390)
    }
