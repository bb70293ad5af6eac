"""Licences, near copies, scores, decontamination and quality against plain Python or SQL."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from ledgerlink.llm.common import components
from ledgerlink.llm.decontaminate import contamination, drop_contaminated, keep_clean
from ledgerlink.llm.licenses import TEMPLATES, compile_template, license_scan
from ledgerlink.llm.ppm import ppm_scores
from ledgerlink.llm.queries import QUERIES, SQL
from ledgerlink.llm.rules import STATISTICS, fit_rules, keep_good, learn_quality, score_quality, text_statistics
from ledgerlink.llm.simhash import keep_one, simhash_groups
from tests.compare import differences, duck
from tests.llm.conftest import SF, wide


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    with duck(SF) as con:
        assert differences(QUERIES[name](spark, SF), con, SQL[name]) is None


# Licences


def accepts(markup, text):
    return compile_template(markup).accepts_at(text.encode().split(), 0)


def test_template_regions():
    assert accepts("a [[b]] c", "a b c") and accepts("a [[b]] c", "a c")
    assert not accepts("a [[b]] c", "a x c") and not accepts("a [[b]] c", "a b")
    assert accepts("a {{1..2}} c", "a x c") and accepts("a {{1..2}} c", "a x y c tail")
    assert not accepts("a {{1..2}} c", "a c") and not accepts("a {{1..2}} c", "a x y z c")
    assert accepts("{{x y|z}} end", "x y end") and accepts("{{x y|z}} end", "z end") and not accepts("{{x y|z}} end", "x end")
    assert accepts("a [[b [[c]] d]] e", "a b d e") and accepts("a [[b [[c]] d]] e", "a e") and not accepts("a [[b [[c]] d]] e", "a c e")
    for bad in ("a [[b", "a ]] b", "[[a]]", "a {{b"):
        with pytest.raises(ValueError):
            compile_template(bad)


def test_license_edges(spark, edges, empty, edge_rows):
    got = {r.doc_id: r for r in license_scan(edges).collect() if r.doc_id not in (None, 3, 4)}
    assert got[0].n_words == got[1].n_words == 0 and got[0].labels == "" and got[0].first_word is None
    assert got[14].base_labels == "cc-by,mit" and got[14].labels == "cc-by,cc-by-notice,mit,mit-notice"
    assert (got[14].n_base, got[14].first_word, got[14].last_word) == (2, 2, 10)
    assert license_scan(edges).count() == len(edge_rows) and license_scan(empty).count() == 0
    text = "Copyright (c) 2024 Some Body. All rights reserved. " + TEMPLATES["mit-text"].replace("[[", "").replace("]]", "")
    row = license_scan(wide(spark, [(1, text), (2, text.replace("free of charge", "for a charge"))])).orderBy("doc_id").collect()
    assert row[0].labels == "copyright-notice,mit-text" and row[1].labels == "copyright-notice"


# Near copies


def fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(max(1, len(words) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reachable(prints, k):
    """The smallest index each index is linked to, over any number of links."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= k:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def groups_of(rows, k=4):
    prints = [fingerprint(t) for _, t in rows]
    roots = reachable(prints, k)
    least = defaultdict(list)
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r].append(i)
    return Counter((i, f"{p:016x}", min(least[r], default=None)) for (i, _), p, r in zip(rows, prints, roots))


@pytest.mark.parametrize("crowded", [256, 1])
@pytest.mark.parametrize("name", ["documents", "edges"])
def test_near_copies(request, name, both, crowded):
    got = simhash_groups(request.getfixturevalue(name), crowded=crowded)
    assert Counter(map(tuple, got.collect())) == groups_of(both[name])


@pytest.mark.parametrize("crowded", [256, 3])
@pytest.mark.parametrize("k", [2, 4, 5])
def test_links_of_dense_fingerprints(spark, crowded, k):
    """Many fingerprints around few centres: no link between groups is lost, whatever path a key takes."""
    from ledgerlink.llm.simhash import links

    rng = random.Random(k)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for c in centres for _ in range(60)}
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    df = spark.createDataFrame([(p, 1 + i % 3) for i, p in enumerate(prints)], "fp bigint, n bigint")
    found = {r.node: r.component for r in components(links(df, k, crowded)).collect()}
    unsigned = [p % (1 << 64) for p in prints]
    want, got = defaultdict(set), defaultdict(set)
    for p, r in zip(prints, reachable(unsigned, k)):
        want[r].add(p)
        got[found.get(p, p)].add(p)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_keep_one(edges, empty, documents):
    kept = keep_one(edges, simhash_groups(edges))
    assert kept.columns == edges.columns
    texts = Counter((r.doc_id, r.text) for r in kept.collect())
    # 0, 1 and 2 have no words; 6, 7 and 8 differ in case only; 3 occurs three times.
    assert texts[0, None] == 1 and not texts[1, ""] and texts[3, "one"] == 1 and texts[6, "same text as another one here"] + texts[5, "a  b   c    d"] == 2
    assert not texts[7, "same text as another one here"] and max(texts.values()) == 1
    assert simhash_groups(empty).count() == 0 and keep_one(empty, simhash_groups(empty)).count() == 0
    groups = simhash_groups(documents)
    assert keep_one(documents, groups).count() == groups.select("component_id").distinct().count()


@pytest.mark.parametrize("name", ["by hand", "ids taken away"])
def test_keep_one_of_each_group_whatever_the_ids(spark, documents, name):
    if name == "by hand":
        a, b, c = ("one text of some words", "quite another text about birds", "a third one that nobody shares")
        rows = [(None, a), (None, a), (None, a.upper()), (None, b), (1, c), (None, c), (2, "x y"), (2, "z"), (2, "z"), (3, "x y"), (1, "only one")]
        rows += [(None, f"distinct words number{i} here{i}") for i in range(20)]
    else:
        rows = [(r.doc_id % 7 or None, r.text) for r in documents.select("doc_id", "text").limit(150).collect()]
    df = wide(spark, rows).repartition(3)
    roots = reachable([fingerprint(t) for _, t in rows], 4)
    root_of = {t: r for (_, t), r in zip(rows, roots)}
    least = defaultdict(list)
    for (i, _), r in zip(rows, roots):
        least[r] += [] if i is None else [i]
    kept = keep_one(df, simhash_groups(df)).collect()
    assert Counter(root_of[r.text] for r in kept) == Counter(set(roots))
    assert all(r.doc_id == min(least[root_of[r.text]], default=None) for r in kept)
    one = wide(spark, [(None, "same words here now"), (1, "same words here now")])
    assert [r.doc_id for r in keep_one(one, simhash_groups(one)).collect()] == [1]
    assert keep_one(one, simhash_groups(one)).schema == one.schema


# Language model


def ppm_by_hand(rows, order):
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    words = [(t or "").encode().lower().split() for _, t in rows]
    streams = [b"\n" * order + b" ".join(w) + b"\n" for w in words]
    unigram, follow = Counter(), [defaultdict(Counter) for _ in range(order + 1)]
    for s, w, h in zip(streams, words, held):
        if not h:
            unigram.update([*w, b"\n"])
            for i in range(order, len(s)):
                for j in range(order + 1):
                    follow[j][s[i - j : i]][s[i]] += 1
    total, distinct = sum(unigram.values()), len(unigram)

    def code(context, symbol):
        out, value = set(), 0.0
        for j in range(order, -1, -1):
            seen = follow[j].get(context[len(context) - j :])
            if seen:
                live = {s: n for s, n in seen.items() if s not in out}
                all_of = sum(live.values()) + len(live)
                if symbol in live:
                    return value + math.log10(live[symbol] / all_of)
                value += math.log10(len(live) / all_of) if live else 0
                out |= set(seen)
        return value - math.log10(252 - len(out))

    memo = {}
    result = []
    for (i, _), s, w, h in zip(rows, streams, words, held):
        score = 0.0
        for at in range(order, len(s)):
            gram = s[at - order : at + 1]
            if gram not in memo:
                memo[gram] = code(gram[:-1], gram[-1])
            score += memo[gram]
        w = [*w, b"\n"]
        base = sum(math.log10((unigram[x] + 1) / (total + distinct + 1)) for x in w)
        result.append((i, h, len(w), sum(x in unigram for x in w), total, round(base, 5), round(score, 5)))
    # A context that was seen shares out exactly 1 over all symbols.
    alphabet = [b for b in range(256) if b not in (9, 11, 12, 13)]
    for context in list(follow[order])[:5]:
        assert abs(sum(10 ** code(context, b) for b in alphabet) - 1) < 1e-9
    return Counter(result)


@pytest.mark.parametrize(("name", "order", "chunk"), [("documents", 5, 100_000), ("edges", 3, 1), ("edges", 5, 1 << 20)])
def test_scores(request, name, both, order, chunk):
    got = ppm_scores(request.getfixturevalue(name), order=order, chunk_bytes=chunk).collect()
    got = Counter((*tuple(r)[:5], round(r.base_score, 5), round(r.score, 5)) for r in got)
    assert got == ppm_by_hand(both[name], order)


def test_scores_without_training_rows(spark, empty):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows = ppm_scores(wide(spark, [(i, "ab c") for i in ids])).collect()
    assert len(rows) == 2 and all(r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in rows)
    assert all(abs(r.score + 5 * math.log10(252)) < 1e-9 for r in rows)
    assert ppm_scores(empty).count() == 0


# Benchmark passages


def contaminated_by_hand(docs, items):
    def words(text):
        low = (text or "").encode().lower()
        return bytes(b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else 32 for b in low).split()

    out = {}
    for i, t in docs:
        w = words(t)
        for k, u in items:
            v = words(u)
            size = min(12, len(v))
            need = 10 if len(v) >= 12 else len(v)
            if len(v) < 6:
                continue
            for a in range(len(w) - size + 1):
                for b in range(len(v) - size + 1):
                    n = sum(x == y for x, y in zip(w[a : a + size], v[b : b + size]))
                    if n >= need:
                        first, last, best = out.get((i, k), (a, 0, 0))
                        out[i, k] = (min(first, a), max(last, a + size - 1), max(best, n))
    return {(*k, *v) for k, v in out.items()}


def test_substitutions_and_short_items(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(30)] + ["é", "x1"]
    items = [(k, " ".join(rng.choices(vocab, k=n))) for k, n in enumerate([3, 6, 8, 11, 12, 13, 20, 40])]
    items += [(100, None), (101, ""), (102, items[6][1])]
    docs = []
    for i in range(60):
        words = items[i % 8][1].split()
        for _ in range(i % 5):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        around = rng.choices(vocab, k=rng.randint(0, 20))
        docs.append((i, ". ".join([*around, *words, *around[::-1]]).upper()))
    docs += [(1, None), (2, ""), (None, items[5][1]), (7, items[7][1])]
    bench = wide(spark, items).withColumnRenamed("doc_id", "item_id")
    found = contamination(wide(spark, docs), bench)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == contaminated_by_hand(docs, items)
    kept = drop_contaminated(wide(spark, docs), found)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in docs if i not in {r[0] for r in rows})


def test_items_without_an_id_and_of_several_lengths(spark):
    words = [f"q{i}" for i in range(60)]
    items = [(None, " ".join(words[:20])), (None, " ".join(words[20:27])), (7, " ".join(words[27:35])), (7, " ".join(words[35:55])), (8, "q1 q2")]
    docs = [(1, items[0][1]), (2, f"a {items[1][1]} b"), (3, f"a b {items[2][1]}"), (4, items[3][1].replace("q40", "z")), (5, "clean words only"), (None, items[2][1])]
    bench = wide(spark, items).withColumnRenamed("doc_id", "item_id")
    rows = [tuple(r) for r in contamination(wide(spark, docs), bench).collect()]
    assert len(rows) == 5 and set(rows) == contaminated_by_hand(docs, items)
    assert [r.doc_id for r in keep_clean(wide(spark, docs), bench).collect()] == [5]


def test_clean_rows_stay_beside_contaminated_ones(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    docs = [(None, f"x {passage} y"), (None, "clean without an id"), (None, None), (5, passage), (5, "clean with the same id"), (6, "clean")]
    bench = wide(spark, [(1, passage)]).withColumnRenamed("doc_id", "item_id")
    kept = keep_clean(wide(spark, docs), bench)
    assert kept.columns == wide(spark, docs).columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(docs[i] for i in (1, 2, 4, 5))


def test_contamination_of_empty_tables(empty, edges):
    items = empty.withColumnRenamed("doc_id", "item_id")
    assert contamination(edges, items).count() == 0
    assert contamination(empty, edges.withColumnRenamed("doc_id", "item_id")).count() == 0


# Quality


def test_quality_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rules = learn_quality(docs, labels)
    scored = score_quality(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), rules).join(labels, "doc_id").collect()
    held = [r for r in scored if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in scored) and len(held) > 800
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.98
    clean = [r for r in held if r.quality == 1]
    assert sum(r.predicted for r in clean) / len(clean) > 0.99
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in scored)


def test_columns_equal_the_fitted_model(spark, edges, edge_rows):
    rng = np.random.default_rng(1)
    stats = rng.random((500, len(STATISTICS)))
    labels = ((stats[:, 2] < 0.5) & (stats[:, 7] > 0.3)).astype(int)
    rules = fit_rules(stats, labels, list(STATISTICS))
    assert 0 < len(rules.rules) < 120 and (np.round(rules.predict(stats, list(STATISTICS))) == labels).mean() > 0.95
    got = Counter((r.doc_id, round(r.score, 9)) for r in score_quality(edges, rules).collect())
    want = rules.predict(np.array([text_statistics((t or "").encode()) for _, t in edge_rows]), list(STATISTICS))
    assert got == Counter((i, round(float(s), 9)) for (i, _), s in zip(edge_rows, want))
    kept = keep_good(edges, rules, cut=0.3)
    assert kept.columns == edges.columns and kept.count() == (want >= 0.3).sum()


def test_labels_of_one_kind_or_none(spark, edges, empty):
    labels = spark.createDataFrame([(3, 1, 0), (5, 1, None), (5, None, 0), (None, 1, 0), (99, 0, 0)], "doc_id bigint, quality int, toxic int")
    one = learn_quality(edges, labels)
    assert not one.rules and all(r.score > 0.5 for r in score_quality(edges, one).collect())
    none = learn_quality(empty, labels.limit(0))
    assert [r.predicted for r in score_quality(edges, none).select("predicted").distinct().collect()] == [0]
    assert score_quality(empty, none).count() == 0
