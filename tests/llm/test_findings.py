"""Cases that a review found lost or changed, each against a slow statement of what is meant."""

import random
import tracemalloc

import pyarrow as pa

from leafmill.llm import common, contamination, increments, linededup, mixing, neardup, pii, queries, tokens, urls

RNG = random.Random(29)
VOCABULARY_FILE = f"{queries.TOKENIZERS}/word_bpe_49k.json"
VOCABULARY = ["".join(RNG.choices("abcdefghijklmnop", k=RNG.randint(2, 8))) for _ in range(3000)]


def babble(n, rng=RNG):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def repeated_places(ordered, n):
    """Places (doc, word) of windows of n words that come earlier in the order."""
    seen, out = set(), set()
    for doc, text in ordered:
        w = text.split()
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            if key in seen:
                out |= {(doc, j) for j in range(i, i + n)}
            seen.add(key)
    return out


def test_increments_where_shorter_pieces_come_first(spark):
    """Each passage's middle of 30 words is in an earlier document of its own; the passage itself repeats later."""
    n = increments.WORDS
    order = [r.id for r in spark.range(240).selectExpr("id", f"pmod(xxhash64(id), {increments.BATCHES}) b").orderBy("b", "id").collect()]
    passages = [babble(n + i % 5) for i in range(40)]
    texts = [" ".join(babble(25) + p[5:35] + babble(25)) for p in passages]
    for _ in range(3):
        texts += [" ".join(babble(30) + p + babble(30)) for p in passages]
    texts += [" ".join(babble(30) + p[5:35] + babble(30)) for p in passages] + [" ".join(babble(80)) for _ in range(40)]
    rows = list(zip(order, texts))
    got = increments.incremental_spans(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    place = {d: i for i, d in enumerate(order)}
    assert {(r.doc_id, i) for r in got for i in range(r.start_word, r.end_word)} == repeated_places(rows, n)
    assert all(place[r.first_doc_id] < place[r.doc_id] for r in got)


def test_decontaminated_in_several_passes(spark):
    """Items that share 8-grams lie in different blocks; the texts are those of one pass."""
    w = babble(60)
    items = [(i, " ".join(w[i * 4 : i * 4 + 14])) for i in range(12)]
    docs = [(1, " ".join(w)), (2, " ".join(babble(9) + w[:30] + babble(9))), (3, None), (4, " ".join(w[20:50])), (5, " ".join(w[:4] + w[20:34] + w[4:8])), (6, " ".join(babble(30)))]
    df, benchmark = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    one = sorted(map(repr, contamination.decontaminated(df, benchmark).collect()))
    several = contamination.decontaminated(df, benchmark, limit=120)
    assert len(contamination.blocks_of(benchmark, 8, 4, 120)) > 2
    assert several.columns == df.columns and sorted(map(repr, several.collect())) == one


def test_rare_words_count_whatever_the_size(spark):
    """Over two million running words, words met twice still cut a host as on a small table."""
    rare = [(1, "http://zorblaxquim.example.com/hapax/1", "zorblax quim"), (2, "http://casinowin.example.com/hapax/2", "zorblax quim casino win")]
    few = [*rare, *((i, f"http://goodnews.example.com/story/{i}", "good news casino win") for i in range(3, 9))]
    many = [*few, (99, "http://goodnews.example.org/story/99", "good news " * 1_500_000)]
    got = {r.page_id: r for r in urls.url_filter(spark.createDataFrame(many, "page_id bigint, url string, html string"), VOCABULARY_FILE).collect()}
    assert got[1].words == "zorblax quim example"
    model = urls.unigram(spark.createDataFrame(few, "page_id bigint, url string, html string"), VOCABULARY_FILE)
    assert urls.host_words("zorblaxquim.example.com", model) == got[1].words.split()


def test_cues_in_any_case():
    a = pii.automaton()
    for before in ("", "İ İstanbul "):
        for text, kind, value in (("Customer ID: 48291734", "account", "48291734"), ("Member ID 7734519", "account", "7734519"), ("Tax ID 982736451", "account", "982736451"), ("Api_Key = abcd1234efgh", "secret", "abcd1234efgh"), ("PassWord: hunter2hunter2", "secret", "hunter2hunter2")):
            assert [(k, (before + text)[x:y]) for x, y, k in pii.finds(before + text, a)] == [(kind, value)], text


def test_no_row_is_lost_when_other_columns_differ(spark):
    rows = [(1, "abc def", "a", "en"), (1, "abc def", "a", "de"), (1, "abc def", "a", "de"), (2, "xyz", "b", "en"), (3, "", "c", "en"), (4, None, "c", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    got = [(r.doc_id, r.text, r.source, r.lang) for r in mixing.mixed(docs, {"a": 7.0, "b": 1.0}).collect()]
    assert set(rows) == set(got) and got.count(rows[0]) in (1, 2) and got.count(rows[4]) == got.count(rows[5]) == 1
    for run in (linededup.deduplicated, neardup.without_near_duplicates):
        kept = [tuple(r) for r in run(docs).collect()]
        again = [tuple(r) for r in run(docs.repartition(3).orderBy("lang")).collect()]
        assert sorted(map(repr, kept)) == sorted(map(repr, again)) and len([r for r in kept if r[0] == 1]) == 1


def test_hot_buckets_are_split_without_loss(spark, monkeypatch):
    """Unlike texts and copies under one band key, whole and in blocks of four."""
    base = babble(200)
    texts = [" ".join(base[: 120 + i % 3] + babble(80)) for i in range(40)] + [" ".join(base + [f"x{i}"]) for i in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    whole = sorted(map(tuple, neardup.near_duplicates(docs).collect()))
    monkeypatch.setattr(neardup, "BLOCK", 4)
    assert len(whole) >= 24 and sorted(map(tuple, neardup.near_duplicates(docs).collect())) == whole


def test_mixing_against_a_plain_rounding(spark, monkeypatch):
    """The whole tree of roundings again, with lists."""
    monkeypatch.setattr(mixing, "RUN", 2)
    rows = [(i, "x" * (1 + i % 5), ["p", "q", "q", None][i % 4]) for i in range(157)] + [(7, "same", "q")] * 9
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    weights, seed, leaf, fan = {"p": 3.0, "q": 1.0}, 5, 10, 3
    got = {}
    for r in mixing.mixed(docs, weights, 1.5, seed, leaf, fan).collect():
        got[r.doc_id, r.text, r.source] = got.get((r.doc_id, r.text, r.source), 0) + 1
    keys = {(r.doc_id, r.text, r.source): bytes(r.k) for r in docs.withColumn("k", mixing.row_key("doc_id", "text", "source")).collect()}
    size = {s: sum(len(t) for _, t, x in rows if x == s) for s in ("p", "q", None)}
    total, largest = sum(size.values()) * 1.5, max(sum(x == s for _, _, x in rows) for s in size)
    nodes_of = {(r.k, r.n, r.m): r.h for r in spark.createDataFrame([(k, n, m) for k in set(keys.values()) for n in range(1, 11) for m in range(1, 20)], "k binary, n bigint, m bigint").selectExpr("k", "n", "m", f"pmod(xxhash64(k, n, {seed}), m) h").collect()}
    nodes_of = {(bytes(k), n, m): h for (k, n, m), h in nodes_of.items()}
    want = {}
    for s, weight in (("p", 0.75), ("q", 0.25), (None, 0.0)):
        own, seen = [], {}
        for d in rows:
            if d[2] == s:
                seen[d] = seen.get(d, 0) + 1
                own.append((keys[d], seen[d], d))
        due = weight * total / size[s]
        for d in seen:
            want[d] = seen[d] * int(due)
        count = -(-len(own) // leaf)
        now = [(nodes_of[k, n, count], k, n, d, due - int(due)) for k, n, d in own]
        levels, step = -(-largest // leaf), 0
        while True:
            rest = []
            for node in sorted({x[0] for x in now}):
                group = sorted((x for x in now if x[0] == node), key=lambda x: (x[1], x[2]))
                numbers = [int.from_bytes(x[1][:8], "big") ^ x[2] * 0x9E3779B97F4A7C15 & (1 << 64) - 1 for x in group]
                decided, at, mass = mixing.pivotal([x[4] for x in group], numbers, seed + step)
                for i, (x, up) in enumerate(zip(group, decided)):
                    if up >= 0:
                        want[x[3]] += up
                    elif levels <= 1:
                        want[x[3]] += mixing.uniform(numbers[i], seed + step, 0) < mass
                    else:
                        rest.append((node // fan, x[1], x[2], x[3], mass))
            if levels <= 1:
                break
            now, levels, step = rest, -(-levels // fan), step + 1
    assert got == {d: n for d, n in want.items() if n}


def peak_bytes(work):
    """The most that Python and numpy held at once while work() ran."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_shard():
    """A shard of texts takes a bounded multiple of its bytes; hashing it in one go took over 50 bytes for each."""
    text = " ".join(babble(1000))
    texts = pa.array([text] * (contamination.SHARD_BYTES // len(text) + 1))
    phrases = contamination.Phrases([(1, " ".join(babble(40)))], contamination.N, contamination.MIN_WORDS)
    assert peak_bytes(lambda: contamination.Shard(phrases).spans(texts)) < 25 * contamination.SHARD_BYTES
    one_mb = texts.slice(0, (1 << 20) // len(text))
    assert peak_bytes(lambda: neardup.shingle_hashes(one_mb, 3, tokens.Powers())) < 26 << 20


def test_hashes_whatever_the_cut():
    """Words have the hashes of one go however few bytes are taken at a time, long words and texts without any included."""
    texts = pa.array(["", None, "a", "x" * 300, " ".join(babble(50)), "éé—ü 漢字 9", "  ...  ", "y" * 70 + " " + "z" * 5, " ".join(babble(200))], pa.large_string())
    words = tokens.Words(*tokens.buffer_of(texts), tokens.alphanumeric())
    whole = words.hashes(tokens.byte_values(), tokens.Powers()).tolist()
    for limit in (1, 7, 64, 1 << 18):
        assert tokens.word_hashes(words, tokens.Powers(), limit).tolist() == whole
    none = tokens.Words(*tokens.buffer_of(pa.array([None, ""], pa.large_string())), tokens.alphanumeric())
    assert len(tokens.word_hashes(none, tokens.Powers())) == 0


class Caught:
    """Stands for a table; keeps the map that is to run over it."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def caught(plan, *args):
    rows = Caught()
    plan(rows, *args)
    return rows.run


def listing(text, lists, ids):
    """A batch as ranges() takes it: of each row its text and the (first_row, share, first_doc_id, lo, hi, first_lo) listed."""
    names = ("first_row", "share", "first_doc_id", "lo", "hi", "first_lo")
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
    listed = pa.array([[dict(zip(names, x)) for x in own] for own in lists], pa.list_(pa.struct(list(zip(names, types)))))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(range(len(ids)), pa.int64()), pa.array(text, pa.string()), listed], names=["doc_id", "row", "text", "listed"])


def test_memory_of_increments(spark):
    """The workers' numpy and Python memory is bounded, however large the batch, and however many ranges a text has."""
    text = " ".join(babble(1000))
    n = (4 << 20) // len(text)
    ids = pa.array(range(n), pa.int64())
    docs = pa.RecordBatch.from_arrays([ids, ids, pa.array([text] * n)], names=["doc_id", "row", "text"])
    used_up = lambda run, batch: peak_bytes(lambda: [None for _ in run(iter([batch]))])
    assert used_up(caught(increments.window_hashes), docs) < 30 << 20
    window = [{"batch": 1, "pos": 500, "before": 10, "more": 10}]
    listed = pa.array([window] * n, pa.list_(pa.struct([(c, pa.int32()) for c in window[0]])))
    assert used_up(caught(increments.whole_runs, increments.WORDS), docs.append_column("listed", listed)) < 30 << 20
    long = " ".join(babble(20_000))
    assert used_up(caught(increments.ranges, increments.WORDS), listing([long], [[(i, 0, i, 0, 20_000, 0) for i in range(300)]], [1])) < 20 << 20
    same = [pa.array([0] * n, t) for t in (pa.int64(), pa.int64())] + [pa.array([0] + [1] * (n - 1), pa.int32()), ids, ids, *(pa.array([0] * n, t) for t in (pa.int32(), pa.int32(), pa.int64())), pa.array([text.encode()] * n)]
    pairs = pa.RecordBatch.from_arrays(same, names=["first_row", "share", "kind", "doc_id", "row", "start", "first_start", "first_doc_id", "text"])
    assert used_up(increments.compared(increments.WORDS), pairs) < 4 << 20


def test_ranges_whatever_the_piece(spark, monkeypatch):
    """The words about each range are the same however few bytes are taken at a time; texts without ranges, null ids and cut batches included."""
    texts = ["", " ".join(babble(300)), " x\x0b\ty é\u2003z ", " ".join(babble(90)), None]
    lists = [[], [(7, i % 2, None if i % 3 else i, lo := RNG.randrange(280), lo + RNG.randrange(1, 80), RNG.randrange(300)) for i in range(50)], [(8, 0, 1, 1, 2, 0)], [(9, 1, 2, 0, 90, 3), (9, 0, 2, 60, 85, 1)], []]
    batch, want = listing(texts, lists, [4, None, 5, 6, 7]), []
    for row in batch.slice(1).to_pylist():
        words = (row["text"] or "").encode().split()
        for r in row["listed"]:
            start = max(0, r["lo"] - 40, r["lo"] - r["first_lo"])
            want.append((r["first_row"], r["share"], 1, row["doc_id"], row["row"], start, start - r["lo"] + r["first_lo"], r["first_doc_id"], b" ".join(words[start : r["hi"] + 40])))
    for piece in (1, 500, 1 << 19):
        monkeypatch.setattr(increments, "PIECE", piece)
        out = [b for b in caught(increments.ranges, 40)(iter([batch.slice(1)]))]
        assert [tuple(x.values()) for b in out for x in b.to_pylist()] == want


def test_batches_to_workers_are_small(spark):
    """incremental_spans() is computed while Arrow batches are small; the session's setting comes back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(2000, numPartitions=1).selectExpr("id", "repeat('word ', 2000) text")
    sizes = lambda: max(r.n for r in docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n bigint").collect())
    whole = sizes()
    try:
        with common.small_batches(spark):
            assert sizes() < 2 * (1 << 22) < whole
            raise KeyError
    except KeyError:
        assert spark.conf.get(key) == before
    text = " ".join(babble(60))
    got = increments.incremental_spans(spark.createDataFrame([(1, text), (2, text)], "doc_id bigint, text string"))
    assert "MapInArrow" not in got._jdf.queryExecution().toString()
    assert [(r.start_word, r.end_word) for r in got.collect()] == [(0, 60)]
    assert spark.conf.get(key) == before


def test_a_batch_is_written_once(spark, monkeypatch):
    """Of a batch's first places only the run is kept, a file a bucket, and none of those that an earlier run has."""
    cuts = []
    monkeypatch.setattr(increments, "cut", lambda df: cuts.append(df) or common.cut(df))
    docs = spark.createDataFrame([(i, " ".join(babble(60))) for i in range(20)] + [(20, " ".join(["again"] * 90))], "doc_id bigint, text string")
    hashes = increments.window_hashes(increments.rows_of(docs)).cache()
    index = increments.Index(spark, buckets=3)
    assert index.add(hashes).count() == hashes.count() - hashes.select("hash").distinct().count() > 0
    assert index.add(hashes).count() == hashes.count() - hashes.select("hash").distinct().count()
    assert len(cuts) == 2
    first, second = index.runs
    assert first.read().count() == hashes.select("hash").distinct().count() and second.read().count() == 0
    assert second.met().exceptAll(first.read()).count() == 0
    assert all(len(r.spark.table(r.name).inputFiles()) <= 3 for r in index.runs)
    index.drop()
