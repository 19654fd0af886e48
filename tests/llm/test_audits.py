"""Source divergence, URL filters and centroid clustering against brute force, on hard cases and on empty tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from changefold.llm import centroids, divergence, url_rules
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_corpus import corpus, frame

# Source divergence


def brute_terms(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = (text or "").translate(str.maketrans(upper, upper.lower()))
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", plain)


def brute_audit(rows, min_documents=3, top=200):
    """Rows (lang, source, part, item, value, rank) of (text, lang, source)."""
    groups, of_lang, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = brute_terms(text)
        groups[lang or "", source or ""].update(terms)
        of_lang[lang or ""].update(terms)
        docs[lang or ""].update(set(terms))
    kept = {lang: [t for t in of_lang[lang] if docs[lang][t] >= min_documents] for lang in of_lang}

    def smoothed(counts, lang):
        total = sum(counts[t] for t in kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept[lang])) for t in kept[lang]}

    p = {g: smoothed(counts, g[0]) for g, counts in groups.items()}
    out = []
    for lang, source in groups:
        own, whole = p[lang, source], smoothed(of_lang[lang], lang)
        parts = {
            "pair": [
                (sum((own[t] - q) ** 2 // q for t, q in p[lang, other].items()), other) for l, other in groups if l == lang and other != source
            ],
            "term": [((own[t] - q) ** 2 // q, t) for t, q in whole.items() if groups[lang, source][t] and own[t] > q],
        }
        for part, found in parts.items():
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            for rank, (value, item) in enumerate(found[: top if part == "term" else None], 1):
                out.append((lang, source, part, item, value, rank))
    return Counter(out)


AUDIT = ["lang", "source", "part", "item", "value", "rank"]


def audited(docs, **options):
    return Counter(tuple(r) for r in divergence.audit_sources(docs, **options).select(*AUDIT).collect())


def group_rows():
    """Groups of many terms, so that counts have bitsets, and many chunks; a hot group; groups without terms."""
    rng = random.Random(3)
    vocabulary = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'efghijklmn'[i // 1000]}" for i in range(6000)]
    rows = []
    for i in range(60):
        own = vocabulary[:: 1 + i % 3]
        rows.append((" ".join(rng.choices(own, k=2500) + ["the"] * rng.randrange(300)), "en", f"s{min(i % 11, 7)}"))
    rows += [(" ".join(vocabulary), "en", "s9"), (" ".join(vocabulary), "en", "s9"), (" ".join(vocabulary[:4500] * 2), "en", "s9")]
    rows += [("123 456", "en", "none"), (None, "en", None), ("", None, None), ("ä Ö É é 東京 a_b", "de", "x")] * 3
    rows += [("only here", "rare", "y"), ("once", "rare", "z")]
    return rows + [(t, "xx" if i % 2 else "en", f"c{i % 4}") for i, t in enumerate(corpus())]


def test_op11_equals_brute_force(spark):
    rows = group_rows()
    docs = frame(spark, [(i, t, lang, source, 0) for i, (t, lang, source) in enumerate(rows)]).repartition(5)
    expected = brute_audit(rows)
    assert audited(docs) == expected
    assert max(Counter(k[:2] for k in expected if k[2] == "term").values()) == 200
    assert audited(docs, tile=3) == expected


def test_op11_of_empty_tables_and_limits(spark, empty):
    assert audited(empty) == Counter()
    rows = [("a b c", "l", "x"), ("a b d", "l", "y"), ("a a a", "l", "z")]
    docs = frame(spark, [(None, t, lang, source, 0) for t, lang, source in rows])
    for options in ({}, {"min_documents": 1}, {"min_documents": 4}, {"min_documents": 1, "top": 1}):
        expected = brute_audit(rows, **options)
        assert audited(docs, **options) == expected
    assert set(k[4] for k in brute_audit(rows, min_documents=4)) == {0}


counts = st.lists(st.integers(0, 12), min_size=200, max_size=200)


@settings(max_examples=40, deadline=None)
@given(counts, counts, st.integers(0, 6))
def test_op11_cells_and_complements_make_up_every_term(a, b, few):
    """The value of a chunk from bitsets, lists and complements equals the sum over terms."""
    a, b = ([c if i % (few + 1) == 0 else c % 3 for i, c in enumerate(x)] for x in (a, b))
    a[0], b[1] = a[0] + 10**6, b[1] + 10**7

    def levels(values):
        slots = np.flatnonzero(values)
        n = np.array(values, np.int64)[slots]
        if not len(n):
            return None
        known, level, sizes = np.unique(n, return_inverse=True, return_counts=True)
        dense = sizes >= divergence.FEW
        at = dense[level]
        bits = np.zeros((int(dense.sum()), divergence.CHUNK), np.uint8)
        bits[(np.cumsum(dense) - 1)[level[at]], slots[at]] = 1
        packs = (known[dense], np.packbits(bits, axis=1, bitorder="little"), n[~at], slots[~at].astype(np.int32))
        row = dict(zip(("counts", "bitsets", "few_counts", "few_slots"), map(divergence.packed, packs)))
        return divergence.Levels(row, sum(values), len(values))

    pa, pb = ([divergence.smoothed(c, sum(x), len(x)) for c in x] for x in (a, b))
    za, zb = (divergence.smoothed(0, sum(x), len(x)) for x in (a, b))
    ab = sum((p - q) ** 2 // q - (za - zb) ** 2 // zb for p, q in zip(pa, pb))
    ba = sum((q - p) ** 2 // p - (za - zb) ** 2 // za for p, q in zip(pa, pb))
    assert divergence.pair_values(levels(a), levels(b), za, zb) == (ab, ba)


def test_op11_cuts_long_texts_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE_BYTES", 7)
    text = "Some words, ÄÖ und averyveryverylongone x " * 9
    got = [t for part in divergence.terms_of(text.encode()) for t in part]
    assert [t.decode() for t in got] == brute_terms(text)


# URL filters


def brute_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule in rules:
        if rule is None or verdict is None:
            continue
        at = rule.find("/") if "/" in rule else len(rule)
        own, start = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rule[:at]), rule[at:]
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            best = max(best or (), (len(own + start), own.count("."), own + start, verdict))
    verdict = best[3] if best else "allow" if host else "block"
    return host, path, best[2] if best else None, verdict


URLS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "http:///es/",
    "http://com",
    "http://com/",
    "http://COM?x",
    "http://a.b.example.com/en/x?y#z",
    "https://www.example.com/en/",
    "https://WWW.Example.com/EN/",
    "https://xwww.example.com/en/1",
    "https://notexample.com/en/1",
    "https://m.x.net/es/1",
    "https://m.x.net/e",
    "https://net/fr/",
    "https://internet/es/",
    "ftp://x://y.net/es/",
    "http://u@example.com:80/en/",
    "http://..net/es/",
    "http://é.example.com/en/ü",
    "http://a\nb.com/x\ny",
    "http://a.com/" + "p" * 50_000,
    "http://" + "s." * 2_000 + "com/en/",
]


def judged(spark, urls, rules):
    rows = [(i % 7 or None, u, "clash", "clash") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, row string, host string").repartition(3)
    out = url_rules.judge_urls(pages, url_rules.rule_table(spark, rules))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    got = Counter(tuple(r) for r in out.collect())
    assert got == Counter((i % 7 or None, *brute_verdict(u, rules)) for i, u in enumerate(urls))


def test_op12_equals_brute_force(spark):
    judged(spark, URLS, url_rules.RULES)


def test_op12_nested_rules_over_many_ranges_and_a_hot_url(spark):
    rng = random.Random(4)
    hosts = ["com", "example.com", "a.example.com", "b.a.example.com", "net", "x.net", "", "example.com:80"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/a/b/c", "/b", "/é/", "/a" * 30]
    every = [(rng.choice(["allow", "block"]), f"{h}{p}") for h in hosts for p in paths]
    rules = rng.sample(every, 45) + [("block", "Example.com/a"), ("allow", "example.com/a"), ("allow", None), (None, "com/")]
    urls = [f"http://{rng.choice(['', 'm.', 'w.w.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'x', '/', '?q'])}" for _ in range(900)]
    judged(spark, urls + ["http://m.example.com/a/b"] * 500, rules)


def test_op12_without_rules_or_urls(spark):
    judged(spark, URLS, [])
    judged(spark, [], url_rules.RULES)


def test_op12_a_rule_goes_to_the_ranges_of_its_interval_only(spark):
    urls = [f"http://h{i:03d}.com/" for i in range(400)]
    rows = spark.createDataFrame(list(enumerate(urls)), "row long, url string")
    keys = url_rules.url_keys(url_rules.with_host_and_path(rows), [1, 2])
    cuts = url_rules.range_cuts(keys, 4)
    assert len(cuts) == 3
    rules = url_rules.rule_intervals(url_rules.rule_table(spark, [("block", "com/"), ("block", "h007.com/")]))
    copies = Counter(r["rule"] for r in url_rules.dealt(keys, rules, cuts).where("rule IS NOT NULL").collect())
    assert copies["h007.com/"] == 1 and 1 <= copies["com/"] <= 4


def test_op12_drop_blocked(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    kept = {r["page_id"] for r in url_rules.drop_blocked(pages, url_rules.rule_table(spark, url_rules.RULES)).collect()}
    assert kept == {i for i, u in enumerate(URLS) if brute_verdict(u, url_rules.RULES)[3] == "allow"}


# Centroid clustering


def brute_clusters(rows, dimensions, clusters=16, rounds=3, scale=64):
    kept = []
    for vec_id, vector in rows:
        if vector is not None and len(vector) == dimensions and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(max(-centroids.LIMIT, min(centroids.LIMIT, scale * float(x)))) for x in vector]))
    digest = {i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest()) for i, _ in kept}
    means = [v for _, v in sorted(kept, key=lambda r: (digest[r[0]], r[1]))[:clusters]]

    def assigned():
        distances = [[sum((a - b) ** 2 for a, b in zip(v, m)) for m in means] for _, v in kept]
        return [(min(range(len(d)), key=lambda c: (d[c], c)), min(d)) for d in distances]

    for _ in range(rounds):
        members = defaultdict(list)
        for (cluster, _), (_, v) in zip(assigned(), kept):
            members[cluster].append(v)
        means = [[sum(x) // len(x) for x in zip(*members[c])] if c in members else m for c, m in enumerate(means)]
    last = assigned()
    own, largest = Counter(), (1 << 63) - 1
    for cluster, distance in last:
        own[cluster] += distance
    return Counter(
        (i, c, d, min(own[c], largest), min(sum(own.values()), largest), hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest())
        for (i, _), (c, d) in zip(kept, last)
    )


def vector_rows(dimensions=5):
    rng = random.Random(6)
    centers = [[rng.uniform(-1, 1) for _ in range(dimensions)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in rng.choice(centers)]) for i in range(150)]
    rows += [(None, [0.5] * dimensions), (None, [0.25] * dimensions), (7, [0.1] * dimensions), (7, [0.1] * dimensions)]
    rows += [(200 + i, rows[3][1]) for i in range(120)]
    bad = [None, [], [0.1] * (dimensions - 1), [0.1] * (dimensions + 1), [None, *[0.1] * (dimensions - 1)]]
    bad += [[float(x), *[0.1] * (dimensions - 1)] for x in ("nan", "inf", "-inf")]
    return rows + [(900 + i, v) for i, v in enumerate(bad)]


def clustered(spark, rows, dimensions, clusters=16, kind="array<double>", **options):
    table = spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], f"vec_id long, embedding {kind}, label int, cluster string")
    vectors = centroids.integer_vectors(table.repartition(3), 64, dimensions)
    segments = centroids.encode_segments(vectors, **options)
    first = centroids.first_centroids(vectors, clusters)
    width = options.get("width", centroids.WIDTH)
    means = centroids.fit(segments, first, 3, width) if first else []
    return Counter(tuple(r) for r in centroids.assign(segments, means, width).collect())


@pytest.mark.parametrize("options", [{}, {"segment": 7}, {"width": 1}, {"width": 3, "segment": 50}])
def test_op13_equals_brute_force(spark, options):
    rows = vector_rows()
    assert clustered(spark, rows, 5, **options) == brute_clusters(rows, 5)


def test_op13_with_fewer_vectors_than_clusters_and_with_none(spark):
    rows = [(i, [i / 10, -i / 10]) for i in range(5)]
    assert clustered(spark, rows, 2) == brute_clusters(rows, 2)
    assert clustered(spark, rows, 3) == Counter()
    assert clustered(spark, [], 2) == Counter()


def test_op13_clusters_may_stay_empty_and_ties_go_to_the_smaller_number(spark):
    rows = [(i, [0.0, 0.0]) for i in range(20)] + [(50, [1.0, 0.0]), (51, [-1.0, 0.0])]
    assert clustered(spark, rows, 2, clusters=4) == brute_clusters(rows, 2, clusters=4)


def test_op13_large_components_are_held(spark):
    rows = [(i, [x, -x]) for i, x in enumerate([1e30, 3e38, -1e9, 2.0**21, -(2.0**21), 0.5, 12345.678])]
    assert clustered(spark, rows, 2, clusters=2) == brute_clusters(rows, 2, clusters=2)
    assert clustered(spark, [(1, [0.1, 0.3])], 2, kind="array<float>") == brute_clusters([(1, [float(np.float32(0.1)), float(np.float32(0.3))])], 2)
    far = [(i, [2.0**21 * (-1) ** i] * 64) for i in range(40)]
    assert clustered(spark, far, 64, clusters=1) == brute_clusters(far, 64, clusters=1)


def test_op13_encoding_is_lossless(spark):
    rows = [r for r in vector_rows(4) if r[0] is not None and r[0] < 300]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = centroids.integer_vectors(table, 64, 4)
    back = []
    for row in centroids.encode_segments(vectors, segment=40).collect():
        held = centroids.Segment(row["sizes"], row["subvectors"], row["codes"], 4, centroids.WIDTH)
        whole = np.concatenate([d[c] for d, c in zip(held.dictionaries, held.codes)], 1)
        assert len(row["vec_ids"]) <= 40
        back += [(i, tuple(map(int, v))) for i, v in zip(row["vec_ids"], whole)]
    assert Counter(back) == Counter((r["vec_id"], tuple(r["vector"])) for r in vectors.collect())
