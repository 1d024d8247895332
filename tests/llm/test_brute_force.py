"""Each operator against a slow statement of what it means."""

import itertools
import math
import os
import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from leafmill.llm import components, contamination, fingerprints, increments, linededup, mixing, neardup, pii, queries, suffixes, toxicity, urls

RNG = random.Random(11)
VOCABULARY_FILE = f"{queries.TOKENIZERS}/word_bpe_49k.json"
VOCABULARY = ["".join(RNG.choices("abcdefghijklmnop", k=RNG.randint(2, 8))) for _ in range(3000)]


def babble(n, rng=RNG):
    return [rng.choice(VOCABULARY) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark):
    """Originals, copies, edited copies and passages that several texts share."""
    rng, docs = random.Random(5), []
    originals = [babble(rng.randint(60, 300), rng) for _ in range(40)]
    passage = babble(70, rng)
    for i, w in enumerate(originals):
        docs.append(w)
        if i % 4 == 0:
            docs.append(list(w))
        if i % 5 == 0:
            near = list(w)
            near[rng.randrange(len(near))] = "changed"
            docs.append(near)
        if i % 6 == 0:
            docs.append(babble(50, rng) + passage + babble(50, rng))
    rng.shuffle(docs)
    rows = [(i, " ".join(w)) for i, w in enumerate(docs)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4).cache()


def marked(spans):
    return {(r.doc_id, i) for r in spans for i in range(r.start_word, r.end_word)}


def repeated_words(ordered, n):
    """Places (doc, word) of windows of n words that come earlier in the order."""
    seen, out = {}, set()
    for doc, text in ordered:
        w = text.split()
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            if key in seen:
                out |= {(doc, j) for j in range(i, i + n)}
            else:
                seen[key] = (doc, i)
    return out


def test_suffixes(corpus):
    rows, docs = corpus
    assert marked(suffixes.repeated_spans(docs).collect()) == repeated_words(rows, suffixes.WORDS)


def test_increments(corpus):
    rows, docs = corpus
    batch = {r.doc_id: r.b for r in docs.selectExpr("doc_id", f"pmod(xxhash64(doc_id), {increments.BATCHES}) b").collect()}
    ordered = sorted(rows, key=lambda r: (batch[r[0]], r[0]))
    got = increments.incremental_spans(docs).collect()
    assert marked(got) == repeated_words(ordered, increments.WORDS)
    place = {d: (batch[d], d) for d, _ in rows}
    assert all(place[r.first_doc_id] < place[r.doc_id] for r in got)


def test_index_compacts_and_takes_batches_twice(spark, corpus):
    _, docs = corpus
    hashes = increments.window_hashes(increments.rows_of(docs)).cache()
    index = increments.Index(spark, fan=2, buckets=3)
    index.add(hashes.where("doc_id < 20"))
    distinct = hashes.where("doc_id < 20").select("hash").distinct().count()
    again = index.add(hashes.where("doc_id < 20"))
    assert again.count() == hashes.where("doc_id < 20").count() - distinct
    for lo in (20, 40):
        index.add(hashes.where(f"doc_id >= {lo} and doc_id < {lo + 20}"))
    assert len(index.runs) == 1 and index.runs[0].level == 2
    held = index.runs[0].read()
    assert held.count() == held.select("hash").distinct().count() == hashes.where("doc_id < 60").select("hash").distinct().count()
    index.drop()


def test_near_duplicates(corpus):
    rows, docs = corpus
    shingles = {d: {tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for d, t in rows}
    got = {r.doc_id: r.duplicate_of for r in neardup.near_duplicates(docs).collect()}
    group = lambda d: got.get(d, d)
    hit = total = 0
    for a, b in itertools.combinations(shingles, 2):
        j = len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
        if j >= 0.8:
            total += 1
            hit += group(a) == group(b)
        assert not (j < 0.2 and group(a) == group(b))
    assert total > 10 and hit == total
    assert {r.doc_id for r in neardup.without_near_duplicates(docs).collect()} == {d for d, _ in rows} - set(got)


def test_corrected_similarity():
    rng = np.random.default_rng(1)
    mins = rng.integers(0, 1 << 32, (200, neardup.PERMUTATIONS), dtype=np.uint32)
    other = np.where(rng.random(mins.shape) < 0.7, mins, rng.integers(0, 1 << 32, mins.shape, dtype=np.uint32))
    differ = neardup.differing(neardup.packed(mins).view(np.uint64), neardup.packed(other).view(np.uint64))
    p, c = 1 - differ / neardup.PERMUTATIONS, 2.0**-neardup.BITS
    assert abs(((p - c) / (1 - c)).mean() - 0.7) < 0.02


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (102, 101), (5, 5), (None, 3)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}


def lines_brute(rows):
    def near(a, b):
        if a == b:
            return True
        if min(len(a), len(b)) < linededup.NEAR_CHARS or abs(len(a) - len(b)) > 1:
            return False
        i = 0
        while i < min(len(a), len(b)) and a[i] == b[i]:
            i += 1
        return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]

    before, out = [], {}
    for doc, text in rows:
        kept, lost = [], False
        for line in text.split("\n"):
            s = line.strip()
            gone = bool(s) and any(near(s, b) for b in before)
            lost |= gone
            if s:
                before.append(s)
            if not gone:
                kept.append(line)
        if not lost or any(k.strip() for k in kept):
            out[doc] = "\n".join(kept)
    return out


def test_line_dedup(spark):
    rng, lines = random.Random(3), []
    for _ in range(60):
        s = " ".join(babble(rng.randint(1, 6), rng))
        lines.append(s)
        if len(s) > 5:
            i = rng.randrange(len(s))
            lines += [s[:i] + s[i + 1 :], s[:i] + "Z" + s[i:], s[:i] + "Q" + s[i + 1 :], "  " + s]
    rng.shuffle(lines)
    rows = [(i, "\n".join([*lines[i * 5 : i * 5 + 5], ""])) for i in range(len(lines) // 5)]
    got = {r.doc_id: r.text for r in linededup.deduplicated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == lines_brute(rows)


def test_mixing(spark):
    rows = [(i, "x" * (1 + i % 7), "big" if i % 10 else "small") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mixed(docs, {"big": 1.0, "small": 1.0}, leaf=100, fan=4).collect()
    size = {s: sum(len(t) for _, t, x in rows if x == s) for s in ("big", "small")}
    total = sum(size.values())
    for s in ("big", "small"):
        due, n = total / 2 / size[s], sum(x == s for _, _, x in rows)
        copies = {i: 0 for i, _, x in rows if x == s}
        for r in got:
            if r.source == s:
                copies[r.doc_id] += 1
        assert set(copies.values()) <= {math.floor(due), math.floor(due) + 1}
        assert abs(sum(copies.values()) - due * n) < 1
    assert got and sorted(map(tuple, got)) == sorted(map(tuple, mixing.mixed(docs.repartition(3), {"big": 1.0, "small": 1.0}, leaf=100, fan=4).collect()))


def test_pivotal_keeps_expectations():
    f = [0.2, 0.7, 0.5, 0.9, 0.1, 0.6]
    total = np.zeros(len(f))
    for seed in range(4000):
        out, at, mass = mixing.pivotal(f, list(range(6)), seed)
        own = np.array(out, dtype=float)
        if at is not None:
            own[at] = mass
        assert abs(own.sum() - sum(f)) < 1e-6
        total += own
    assert np.abs(total / 4000 - f).max() < 0.03


def test_toxicity_on_held_out_texts(spark):
    """Half of the labelled rows of the 0.1 tables train, the other half are told apart."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = "pmod(xxhash64(doc_id, 7), 2) = {}"
    held = {r.doc_id: r.toxic for r in labels.where(half.format(1)).collect()}
    found = {r.doc_id for r in toxicity.toxic_documents(docs, labels.where(half.format(0))).collect()}
    right = sum((i in found) == bool(t) for i, t in held.items())
    assert len(held) > 500 and right / len(held) > 0.97


def test_toxicity_finds_held_out_words_and_keeps_columns(spark):
    """Few texts of many rare words: toxic ones are found; clean ones may be rejected, as the README tells."""
    rng, bad = random.Random(8), [f"vile{i}" for i in range(12)]
    rows, labels = [], []
    for i in range(600):
        w = babble(rng.randint(20, 150), rng)
        if i % 3 == 0:
            for _ in range(6):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    given = spark.createDataFrame(labels[:400], "doc_id bigint, quality int, toxic int")
    found = {r.doc_id for r in toxicity.toxic_documents(docs, given).collect()}
    toxic = {i for i, _, t in labels[400:] if t}
    assert len(found & toxic) / len(toxic) > 0.95
    assert {r.doc_id for r in toxicity.without_toxic(docs, given).collect()} == set(range(600)) - found


def test_gradient_of_the_network():
    texts = pytest.importorskip("pyarrow").array([" ".join(babble(30)) for _ in range(4)])
    from leafmill.llm.tokens import Powers

    e = toxicity.Encoded(texts, Powers())
    net = toxicity.Network(e.keys[:5])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, _ = net.inputs(e)
    x = x.astype(np.float64)
    logit, trace = net.forward(x, e.windows, keep=True)
    grads, _ = net.backward(x, e.windows, trace, np.ones(len(logit)))
    for name, g in grads.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old, step = net.p[name][at], 1e-5
        net.p[name][at] = old + step
        up = net.forward(x, e.windows, keep=True)[0].sum()
        net.p[name][at] = old - step
        down = net.forward(x, e.windows, keep=True)[0].sum()
        net.p[name][at] = old
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=2e-2, abs=1e-3), name


def test_personal_data(spark):
    text = "Mail anna.b@example.co.uk or +44 20 7946 0958, card 4111 1111 1111 1111, iban: GB82 WEST 1234 5698 7654 32, host 10.0.0.1, not 1.2.3.4.5 nor a@b, see https://example.com/~anna"
    got = {(r.kind, r.value) for r in pii.personal_data(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()}
    assert {("email", "anna.b@example.co.uk"), ("address", "10.0.0.1")} <= got
    assert any(k == "account" and v.startswith("4111") for k, v in got) and any(v.startswith("+44") for _, v in got)
    assert not any("1.2.3.4" in v or v == "a@b" for _, v in got)
    assert all(text[r.start : r.end] == r.value for r in pii.personal_data(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect())


def test_viterbi_is_the_best_of_all_cuts():
    model = urls.Unigram({"casino": 0.1, "win": 0.2, "sin": 0.05, "ca": 0.05, "owin": 0.01, "now": 0.2, "no": 0.2, "win s": 0.1})
    lp = lambda w: model.log.get(w, model.unknown - len(w) * math.log(10))
    for run in ("casinowin", "nowin", "xcasino", "sinnow", "q"):
        best = max(
            ([run[a:b] for a, b in zip((0, *cuts), (*cuts, len(run)))] for k in range(len(run)) for cuts in itertools.combinations(range(1, len(run)), k)),
            key=lambda words: sum(map(lp, words)),
        )
        assert sum(map(lp, model.segment(run))) == pytest.approx(sum(map(lp, best)))
    assert model.segment("casinowin") == ["casino", "win"]


def test_naive_bayes_against_counts(spark):
    pages = [(i, f"http://{'casinowin' if i % 4 == 0 else 'goodnews'}{i % 3}.example.com/{'bonus' if i % 4 == 0 else 'story'}/{i}", "good news casino win") for i in range(80)]
    pages += [(900, "http://unseen.example.com/bonus/1", None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in urls.url_filter(df, VOCABULARY_FILE).collect()}
    model = urls.unigram(df, VOCABULARY_FILE)
    rows = [(u, urls.split_url(u)) for _, u, _ in pages]
    made = [(urls.features(h, urls.host_words(h, model), rest), "casino" in urls.host_words(h, model)) for _, (h, rest) in rows]
    counts = {}
    for own, positive in made:
        for f in own:
            counts.setdefault(f, [0, 0])[positive] += 1
    low, high = (sum(c[i] for c in counts.values()) for i in (0, 1))
    often = {f: c for f, c in counts.items() if sum(c) >= 2}
    rare = [sum(c[i] for f, c in counts.items() if f not in often) for i in (0, 1)]
    size, n = len(often) + 1, sum(p for _, p in made)
    for (pid, _, _), (own, _) in zip(pages, made):
        score = (urls.SEED_ODDS if "casino" in urls.host_words(urls.split_url(pages[[p[0] for p in pages].index(pid)][1])[0], model) else math.log(n / (len(made) - n))) + sum(math.log((c[1] + 1) / (high + size)) - math.log((c[0] + 1) / (low + size)) for c in (often.get(f, rare) for f in own))
        assert got[pid].score == pytest.approx(score, abs=1e-5)
    assert all(got[i].blocked == (i % 4 == 0) for i in range(80))


def oracle(name, sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f[:-8]} as select * from read_parquet('{sf}/{f}')")
    out = con.execute(queries.ORACLES[name])
    names = [d[0] for d in out.description]
    return sorted(map(repr, (tuple(r[names.index(c)] for c in sorted(names)) for r in out.fetchall())))


@pytest.mark.parametrize("name", ["op2_line_dedup", "op7_fingerprints", "op10_decontamination"])
def test_sql(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert sorted(map(repr, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect()))) == oracle(name, sf)


def test_winnowing_guarantee(spark):
    shared = " ".join(babble(80))
    docs = [(1, " ".join(babble(20)) + shared), (2, shared + " ".join(babble(20)))]
    got = fingerprints.fingerprints(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.hash for r in got if r.doc_id == 1} & {r.hash for r in got if r.doc_id == 2}


def test_pipeline_is_its_stages(spark, sf):
    """The stages, each on what the one before kept, give run()'s rows; each decision took effect."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n, now = docs.count(), docs
    counts = [n]
    for _, stage in corpus_pipeline.STAGES:
        now = spark.createDataFrame(stage(spark, now, sf).toPandas(), stage(spark, now, sf).schema)
        counts.append(now.count())
    got = corpus_pipeline.run(spark, sf)
    assert sorted(map(repr, got.select(sorted(got.columns)).collect())) == sorted(map(repr, now.select(sorted(now.columns)).collect()))
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] >= counts[4] > 0
    assert contamination.contaminated_spans(got.drop("copy"), spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
