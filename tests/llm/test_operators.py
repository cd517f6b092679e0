"""Each operator against a plain version on a fixture with nulls, empty and long texts, ties, repeats and clashing columns."""

import io
import json
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from policylens.llm import ann, chat, fm_toxicity, host_rules, knn_quality, mixing, packing, queries, rolling, setsketch, substring, tokens, warc
from tests.conftest import SF001, SMOKE
from tests.llm import brute

KEY = lambda r: tuple((x is None, x) for x in r)


def same(got, want):
    assert sorted(map(tuple, got), key=KEY) == sorted(want, key=KEY)


def test_host_rules(docs, rows, empty):
    got = host_rules.judged(docs).select("doc_id", "n_words", "base_failed").collect()
    same(got, [(i, len(brute.words(t)), brute.base_failed(t)) for i, t in rows])
    kept = host_rules.reject(docs)
    assert kept.columns == docs.columns
    verdict = host_rules.judged(docs).where("kept").count()
    assert kept.count() == verdict > 0
    assert host_rules.judged(empty).count() == host_rules.reject(empty).count() == 0


def test_bad_host_is_rejected(spark):
    good = " ".join(f"word{k}" for k in range(30))
    data = [(k, good, f"h{k % 4}") for k in range(200)] + [(1000 + k, "short" if k % 20 else good, "bad") for k in range(100)]
    got = host_rules.judged(spark.createDataFrame(data, "doc_id long, text string, source string"))
    assert {r[0] for r in got.where("not kept").select("host").distinct().collect()} == {"bad"}
    assert got.where("kept").count() == 200


def test_hosts_on_both_sides(spark, tmp_path):
    """A host far from what hosts are like goes below the absolute limit, a small one is shrunk, and SQL agrees row by row."""
    duckdb = pytest.importorskip("duckdb")
    good, n = " ".join(f"word{k}" for k in range(30)), 0
    data = []
    for host, rows, failed in [*[(f"h{k}", 100, 4 + k % 3) for k in range(40)], ("bad", 200, 90), ("worse", 50, 45), ("tiny", 3, 1), (None, 60, 3)]:
        data += [(n + k, "short" if k < failed else good, host) for k in range(rows)]
        n += rows
    spark.createDataFrame(data, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.SQL5)
    got = queries.op5_host_rules(spark, str(tmp_path)).select(*want.columns)
    same(got.collect(), want.fetchall())
    decided = got.where("not kept and not base_failed").join(spark.read.parquet(str(tmp_path / "documents.parquet")), "doc_id").groupBy("source").count().collect()
    assert {tuple(r) for r in decided} == {("bad", 110), ("worse", 5)}
    assert host_rules.reject(spark.read.parquet(str(tmp_path / "documents.parquet"))).count() == got.where("kept").count()


def test_near_duplicates(docs, rows, empty):
    for n in (2, 5):
        got = setsketch.NearDuplicates(docs, docs["doc_id"], docs["text"], setsketch.Sketching(shingle=n)).result().collect()
        label = brute.components(rows, n)
        same(got, [(i, len(brute.shingles(t, n)), label.get(i), i is None or label[i] == i) for i, t in rows])
    out = setsketch.one_of_each(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in out.select("doc_id", "text").collect()) == Counter(brute.one_of_each(rows, 5))
    assert setsketch.one_of_each(empty).count() == 0
    assert setsketch.NearDuplicates(empty, empty["doc_id"], empty["text"]).result().count() == 0


def test_near_copies_without_common_leader(spark):
    """Many near copies of one text, some only reachable through others; small blocks."""
    r = random.Random(5)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for k in range(120):
        w = list(base)
        for j in r.sample(range(150), r.randint(0, 22)):
            w[j] = f"x{r.random()}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = setsketch.NearDuplicates(df, df["doc_id"], df["text"], setsketch.Sketching(shingle=2, block=16)).result()
    assert {r[0]: r[2] for r in got.collect()} == brute.components(rows, 2)


def test_registers_estimate_and_merge():
    s = setsketch.Sketching()
    r = np.random.default_rng(1)
    a, b = r.integers(-2**62, 2**62, 800), r.integers(-2**62, 2**62, 700)
    both = np.concatenate([a[:600], b])
    flat = np.concatenate([a, both, np.union1d(a, both)])
    regs = setsketch.registers(flat, np.array([0, 800, 2100, len(flat)]), s)
    assert (np.maximum(regs[0], regs[1]) == regs[2]).all()
    j = setsketch.estimate([800], [1300], regs[:1], regs[1:2], s)[0]
    assert abs(j - 600 / 1500) < 0.12
    assert setsketch.may_link([800], [800], regs[:1], regs[:1], s)[0]


def test_substring(docs, rows, empty):
    left = brute.kept_words([t for _, t in rows])
    want = [(i, len(brute.words(t)), len(brute.words(t)) - len(k), brute.sha(" ".join(k))) for (i, t), k in zip(rows, left, strict=True)]
    for shard in (2048, 4):
        same(substring.Repeats(docs, docs["doc_id"], docs["text"], substring.Passages(shard=shard)).digests().collect(), want)
    out = substring.Repeats(docs, docs["doc_id"], docs["text"]).cleaned(docs)
    assert out.columns == docs.columns
    changed = {(i, " ".join(k)) if len(k) < len(brute.words(t)) else (i, t) for (i, t), k in zip(rows, left, strict=True)}
    assert {tuple(r) for r in out.select("doc_id", "text").collect()} == changed and out.count() == len(rows)
    assert substring.Repeats(empty, empty["doc_id"], empty["text"]).digests().count() == 0


@pytest.mark.parametrize("kind", ["hash(w)", "xxhash64(w) & 4294967295"])
def test_substring_tells_words_of_equal_symbols_apart(spark, kind):
    """Two words whose 32-bit hashes are equal, in the same slot of one template."""
    r = random.Random(1)
    words = spark.range(400_000).selectExpr("concat('n', id) as w").groupBy(F.expr(kind).alias("h"))
    one, two = sorted(words.agg(F.sort_array(F.collect_list("w")).alias("w")).where("size(w) > 1").orderBy("h").first()["w"])[:2]
    head, tail = ([f"w{r.randrange(400)}" for _ in range(60)] for _ in range(2))
    for slots in ([one, two], [one, one, two]):
        own = len(slots) == 3  # else the texts differ in that one word alone
        rows = [(k, " ".join([*head, x, *tail, *[f"own{k}"] * own])) for k, x in enumerate(slots)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        want = [(k, len(brute.words(t)), len(brute.words(t)) - len(left), brute.sha(" ".join(left)))
                for (k, t), left in zip(rows, brute.kept_words([t for _, t in rows]), strict=True)]
        same(substring.Repeats(docs, docs["doc_id"], docs["text"]).digests().collect(), want)


def test_hot_phrase_of_one_text_is_spread(spark, monkeypatch):
    """A long text of one word has one phrase at every place; its stretches go to many groups."""
    locate = substring._locate

    def bounded(p):
        run = locate(p)

        def small_group(stretches, confirmed):
            assert len(stretches) <= 2 * p.shard, f"{len(stretches)} stretches in one group"
            return run(stretches, confirmed)
        return small_group

    monkeypatch.setattr(substring, "_locate", bounded)
    tail = [f"t{k}" for k in range(50)]
    rows = [(1, "x " * 5000 + " ".join(tail)), (2, "a b c " * 1000), (3, " ".join(tail[:20]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(k, len(brute.words(t)), len(brute.words(t)) - len(left), brute.sha(" ".join(left)))
            for (k, t), left in zip(rows, brute.kept_words([t for _, t in rows]), strict=True)]
    same(substring.Repeats(docs, docs["doc_id"], docs["text"], substring.Passages(shard=256)).digests().collect(), want)


def test_rows_of_a_hot_phrase_grow_in_proportion(spark, monkeypatch):
    """Documents of their own words around one notice: what reaches the automata doubles with the documents."""
    r, rows = random.Random(6), {}
    notice = " ".join(f"n{k}" for k in range(34))
    locate = substring._locate

    def counting(p):
        run = locate(p)

        def counted(stretches, confirmed):
            with open(seen, "a") as f:
                f.write(f"{len(stretches)} {len(confirmed)}\n")
            return run(stretches, confirmed)
        return counted

    monkeypatch.setattr(substring, "_locate", counting)
    for n in (128, 256, 512):
        import tempfile
        seen = tempfile.mkstemp(prefix="stretches-")[1]
        texts = [(k, " ".join(f"a{r.randrange(8)}" for _ in range(3)) + f" {notice} " + " ".join(f"b{r.randrange(8)}" for _ in range(3))) for k in range(n)]
        docs = spark.createDataFrame(texts, "doc_id long, text string")
        want = [(k, len(brute.words(t)), len(brute.words(t)) - len(left), brute.sha(" ".join(left))) for (k, t), left in zip(texts, brute.kept_words([t for _, t in texts]), strict=True)]
        same(substring.Repeats(docs, docs["doc_id"], docs["text"], substring.Passages(shard=16)).digests().collect(), want)
        with open(seen) as f:
            rows[n] = np.array([line.split() for line in f], int).sum(0)
    for n in (128, 256):
        assert (rows[2 * n] <= 2.6 * rows[n]).all() and (rows[n] > 0).all()


def test_window_hashes_depend_on_their_ids_alone():
    ids = np.array([5, 6, 7, 8, 9, 5, 6, 7, 8, 9], np.int32)
    for width in (1, 2, 3, 5):
        h = rolling.windows(ids, width)
        assert len(h) == 11 - width and h[0] == h[5] and len(set(h[:5].tolist())) == 5
    v = np.array([3, 1, 2, 1, 5, 0], np.uint64)
    assert rolling.sliding_argmin(v, 3).tolist() == [1, 1, 3, 5]


def test_assign_fills_every_sequence_and_balances():
    plan = packing.Packing("", size=64)
    lengths = [random.Random(k).randint(1, 200) for k in range(300)]
    pieces = packing.assign(lengths, plan)
    at = defaultdict(list)
    for doc, start, length, _, _ in pieces:
        at[doc].append((start, length))
    for doc, n in enumerate(lengths):
        stop = 0
        for start, length in sorted(at[doc]):
            assert start == stop
            stop += length
        assert stop == n
    by = defaultdict(list)
    for _, _, length, seq, offset in pieces:
        by[seq].append((offset, length))
    cost = []
    for seq in by.values():
        stop = 0
        for offset, length in sorted(seq):
            assert offset == stop
            stop += length
        assert stop & (stop - 1) == 0 and stop <= 64
        if stop == 64 and len(seq) > 1:
            cost.append(sum(n + n * n / 64 for _, n in seq))
    assert np.std(cost) < 0.25 * np.mean(cost)


def test_pack_query_against_tokenizers(docs, rows, empty):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    ids = {}
    for i, text in rows:
        got = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want[(i, len(got))] += len(got)
        ids[(i, len(got))] = np.array(got, "<u4")
    plan = packing.Packing(queries.tokenizer_path(), block_tokens=5000)
    out = packing.pack(docs, docs["doc_id"], docs["text"], plan).collect()
    have = Counter()
    for r in out:
        own = ids[(r.doc_id, r.doc_tokens)]
        have[(r.doc_id, r.doc_tokens)] += r.length
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
    assert have == want
    size = Counter()
    for r in out:
        size[r.sequence_id] += r.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in size.values())
    assert packing.pack(empty, empty["doc_id"], empty["text"], plan).count() == 0


def test_encoder_equals_tokenizers():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    encode = tokens.encoder(queries.tokenizer_path())
    texts = [f"a{chr(c)}b {chr(c)}1 {chr(c)}{chr(c)} {chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts += ["a  b", " \n x ", "<|endoftext|> it's 'll", "", "é ñ 你好 😀 x" * 50]
    assert [x.ids for x in t.encode_batch(texts, add_special_tokens=False)] == [encode(x) for x in texts]


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, " " * 99_999, "\u3000" * 100_000])
def test_encoder_of_long_white_space(run):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_path())
    text = f"one{run}two \n three"
    assert tokens.encoder(queries.tokenizer_path())(text) == t.encode(text, add_special_tokens=False).ids


def test_warc_round_trip(spark, tmp_path):
    r = random.Random(2)
    noise = bytes(r.randrange(256) for _ in range(5000)).decode("latin-1")
    magic = (warc.MAGIC * 400).decode("latin-1")
    html = [noise, magic + noise, "x" * 2000, "x" * 2000, "x" * 2000, "y" * 999, "y" * 999, "", None, noise * 40, "x" * 2000]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, None]
    pages = spark.createDataFrame([(i, "http://h/%\n" if i == 1 else None, h, "clash") for i, h in zip(ids, html, strict=True)],
                                  "page_id long, url string, html string, digest string").repartition(2)
    payload = F.encode(F.coalesce(pages["html"], F.lit("")), "UTF-8")
    warc.write_warc(warc.with_revisits(pages, payload), str(tmp_path / "w"))
    want = []
    for i, h in zip(ids, html, strict=True):
        raw = (h or "").encode()
        first = 5 if h == "x" * 2000 else None
        revisit = first is not None and i != first
        want.append((i, len(raw), __import__("hashlib").sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None,
                     None if revisit else raw))
    for size in (8 << 20, 700, 97):
        got = warc.read_warc(spark, str(tmp_path / "w"), size)
        rows = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
                for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload").collect()]
        same(rows, want)
    assert got.where("page_id = 1").first().url == "http://h/%\n"


def test_warc_head_reads_past_a_block(monkeypatch):
    members = [warc._member(k, None, bytes(str(k), "ascii") * 50, "d", "revisit", 9) for k in range(40)]
    data = b"".join(members)
    for block in range(1, 60, 7):
        monkeypatch.setattr(warc, "READ_BYTES", block)
        assert [r["page_id"] for r in warc.records_in(io.BytesIO(data), 0, len(data), len(data))] == list(range(40))


def test_large_member_ends_with_nul(spark, tmp_path):
    pages = spark.createDataFrame([(1, None, "ab" * (9 << 20))], "page_id long, url string, html string")
    warc.write_warc(warc.with_revisits(pages, F.encode("html", "UTF-8")), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).select("payload_bytes").first()[0] == 18 << 20


def test_nearest_recall_and_exactness(spark):
    got = queries.op4_nearest_vectors(spark, SF001).collect()
    data = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").collect()]
    at = dict(data)
    by = defaultdict(list)
    for r in got:
        assert r.score == pytest.approx(float(np.sqrt(((at[r.query_id] - at[r.vec_id]) ** 2).sum())), abs=1e-12)
        by[r.query_id].append((r.rank, r.vec_id))
    hits = 0
    for q in (i for i, _ in data if i % 100 == 0):
        true = sorted((float(np.sqrt(((at[q] - v) ** 2).sum())), i) for i, v in data if i != q)[:10]
        assert [k for k, _ in sorted(by[q])] == list(range(1, 11))
        hits += len({i for _, i in true} & {i for _, i in by[q]})
    assert hits >= 0.9 * 10 * len(by)


def test_nearest_ties_and_unusable_vectors(spark):
    same_vec = [1.0, 2.0, 3.0]
    data = [(k, same_vec) for k in range(30)] + [(100, [1.0, 2.0, 3.5]), (101, None), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 2.0]),
                                                 (104, [1.0, float("nan"), 2.0]), (105, [float("inf"), 1.0, 1.0]), (None, same_vec), (200, [1.0, 2.0]), (300, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = ann.nearest(df, df["vec_id"], df["embedding"], df["vec_id"] % 100 == 0, ann.Graph(shard=8)).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by[r.query_id].append((r.vec_id, r.score))
    assert by == {0: [(k, 0.0) for k in range(1, 11)], 100: [(k, 0.5) for k in range(10)]}
    assert ann.nearest(df.limit(0), df["vec_id"], df["embedding"], df["vec_id"] % 100 == 0).count() == 0


def test_mixing(spark, docs, rows, empty):
    sizes = {"a": 400, "b": 60, "c": 20, None: 5}
    data = [(i, "w " * (1 + i % 7), s, "clash") for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string, epoch string")
    mix = mixing.Mixing(entropy=0.9, repeats=2.0, blocks=32)
    count = Counter()
    for i, _, s, _ in data:
        count[s] += 1 + i % 7
    total = sum(count.values())
    low, high = 0.0, 1.0
    h = lambda t: -sum(w * math.log(w) for w in [(n / total) ** t / sum((m / total) ** t for m in count.values()) for n in count.values()])
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if h(mid) >= 0.9 * math.log(4) else (low, mid)
    limit = 1 - math.log(2) / math.log(max(count.values()) / min(count.values()))
    t, budget = mixing.exponent(mixing.sources(df, df["source"], F.size(F.split(F.trim("text"), " ")).cast("long")), mix)
    assert t == pytest.approx(max(low, limit), abs=1e-6)
    z = sum((n / total) ** t for n in count.values())
    out = mixing.mixed(df, mix)
    got = out.select("row.doc_id", "row.source", "row.text", F.col("epoch")).collect()
    assert {r[0] for r in got} == {d[0] for d in data}
    read = Counter()
    for r in got:
        read[r[1]] += len(r[2].split())
    largest = 7 * 40
    for s, n in count.items():
        wanted = max(n, (n / total) ** t / z * budget)
        assert wanted - largest <= read[s] <= wanted + 1
    assert max(r[3] for r in got) <= 2 and out.select("row.*").columns == df.columns
    assert mixing.mixed(empty).count() == 0
    assert {r[0] for r in mixing.mixed(docs).select("row.doc_id").collect()} == {i for i, _ in rows}


def test_classifiers_on_held_out_rows(spark, docs, rows, empty):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    q = queries.op7_quality(spark, SF001).join(labels, "doc_id").where("held_out")
    assert q.where("predicted = quality").count() >= 0.97 * q.count()
    x = queries.op8_toxicity(spark, SF001).join(labels, "doc_id").where("held_out")
    assert x.where("toxic = 0 and predicted = 1").count() <= 0.02 * x.count()
    assert x.where("toxic = 1 and predicted = 1").count() >= 0.6 * x.where("toxic = 1").count()
    some = spark.createDataFrame([(1, None, 1), (2, 1, 0), (2, 0, 0), (3, 0, 1), (None, 1, 1), (5, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    for lib in (knn_quality, fm_toxicity):
        for table in (some, some.limit(0)):
            got = lib.score(docs, lib.fit(docs, table)).collect()
            assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
            assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
        assert lib.score(empty, lib.fit(empty, some)).count() == 0


def test_quality_by_vocabulary_alone(spark):
    """Good and bad documents differ in nothing but which words they hold."""
    r = random.Random(3)
    made = ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(900)]
    both, good, bad = made[:300], made[300:600], made[600:]
    rows = []
    for k in range(1200):
        y = k % 2
        rows.append((k, " ".join(r.choice(both if r.random() < 0.5 else (good if y else bad)) for _ in range(r.randint(30, 80))), y))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, quality int")
    got = {x.doc_id: x for x in knn_quality.score(docs, knn_quality.fit(docs, labels)).collect()}
    held = [got[k].predicted == y for k, _, y in rows if got[k].held_out]
    assert sum(held) >= 0.95 * len(held)


def test_vote_equals_plain_neighbours():
    r = np.random.default_rng(8)
    v = knn_quality.Voting(k=5)
    vectors = knn_quality.unit(np.round(r.normal(size=(60, 6)), 1))
    vectors[30:40] = vectors[0]  # ties at the last place, of both labels
    model = {"axes": np.eye(6, dtype=np.float32), "vectors": vectors, "labels": (r.random(60) < 0.3).astype(np.float32)}
    x = np.concatenate([r.normal(size=(40, 6)), vectors[:3], np.zeros((1, 6))]).astype(np.float32)
    share = float(model["labels"].mean())
    for q, got in zip(x, knn_quality.vote(x, model, v), strict=True):
        cos = [round(float(np.dot(knn_quality.unit(q[None])[0], u)), 6) for u in vectors]
        least = sorted(cos)[-5]
        votes = [(max(c, 1e-6) ** v.sharpness / (share if y else 1 - share), y) for c, y in zip(cos, model["labels"], strict=True) if c >= least - 1e-9]
        assert got == pytest.approx(sum(w for w, y in votes if y) / sum(w for w, _ in votes), abs=1e-4)


def plain_score(model, terms):
    """w0 + sum of w + the sum over pairs of the products of their vectors."""
    kept = [i for i, t in enumerate(model["terms"].tolist()) if t in terms]
    pairs = sum(float(model["v"][a] @ model["v"][b]) for k, a in enumerate(kept) for b in kept[k + 1:])
    return model["w0"] + sum(model["w"][k] for k in kept) + pairs


def packed(data):
    ids = np.array([x for t, _ in data for x in t], np.int64)
    return ids, np.concatenate([[0], np.cumsum([len(t) for t, _ in data])]), np.array([v for _, v in data], float)


def test_pair_of_terms_outweighs_its_parts():
    """Interactions: only the two terms together make the label, or only one of them without the other."""
    r = random.Random(4)
    for rule in (lambda a, b: a and b, lambda a, b: a != b):
        data = []
        for _ in range(1500):
            t = [k for k in (1, 2) if r.random() < 0.5] + [r.randint(10, 40) for _ in range(3)]
            data.append((sorted(set(t)), float(rule(1 in t, 2 in t))))
        ids, offsets, y = packed(data)
        model = fm_toxicity.train(ids, offsets, y, fm_toxicity.Machine())
        s = fm_toxicity.raw_scores(ids, offsets, model)
        assert ((s > 0) == (y == 1)).mean() > 0.97
        assert s[:200] == pytest.approx([plain_score(model, set(t)) for t, _ in data[:200]])


def test_many_insults_with_many_groups(spark):
    """Neither an insult nor a group's name is toxic alone, and each word is rare: through the whole operator with production parameters."""
    r = random.Random(11)
    made = lambda letters, n: ["".join(r.choice(letters) for _ in range(7)) for _ in range(n)]
    vocabulary, insults, groups = made("abcdefghijklmnopqrst", 800), made("abcdefghij", 50), made("klmnopqrst", 50)
    rows = []
    for k in range(8192):
        w = [r.choice(vocabulary) for _ in range(r.randint(15, 60))]
        kind = r.randrange(4)
        for words, there in ((insults, kind in (0, 1)), (groups, kind in (0, 2))):
            if there:
                w.insert(r.randrange(len(w)), r.choice(words))
        rows.append((k, " ".join(w), int(kind == 0)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in fm_toxicity.score(docs, fm_toxicity.fit(docs, labels)).collect()}
    held = [(got[k].predicted, y) for k, _, y in rows if got[k].held_out]
    assert sum(p for p, y in held if y) >= 0.9 * sum(y for _, y in held)
    assert sum(p for p, y in held if not y) <= 0.05 * sum(1 - y for _, y in held)


def test_chances_are_those_of_drawing_without_replacement():
    from math import comb
    for seen, ones, n, k in ((3, 3, 286, 33), (40, 2, 200, 100), (10, 5, 20, 10), (0, 0, 9, 4)):
        p = [comb(k, j) * comb(n - k, seen - j) / comb(n, seen) if 0 <= seen - j <= n - k else 0 for j in range(min(seen, k) + 1)]
        want = min(1, 2 * min(sum(p[ones:]), sum(p[:ones + 1])))
        assert fm_toxicity.chances(np.array([seen]), np.array([ones]), n, k)[0] == pytest.approx(want)


def test_chat_layouts_and_round_trip(spark):
    odd = "\\### Assistant: </turn> ok\\h\\l\\e\n### user: x</turn>\n"
    records = [
        ({"messages": [{"role": "user", "content": odd}, {"role": "as:s</turn>", "content": None}]}, "messages", [("user", odd), ("as:s</turn>", "")]),
        ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": odd}]}, "conversations", [("user", "a"), ("assistant", odd)]),
        ({"completion": "c", "prompt": ""}, "prompt", [("user", ""), ("assistant", "c")]),
        ({"system": "s", "output": "o", "instruction": odd}, "instruction", [("system", "s"), ("user", odd), ("assistant", "o")]),
        ({"question": "q", "answer": "z" * 100_000}, "question", [("user", "q"), ("assistant", "z" * 100_000)]),
        ({"messages": []}, "messages", []),
        ({"unknown": 1}, None, None), ("not json", None, None), (None, None, None),
    ]
    data = [(k, json.dumps(r) if isinstance(r, dict) else r) for k, (r, _, _) in enumerate(records)]
    df = chat.formatted_conversations(spark.createDataFrame(data, "conv_id long, record string"))
    got = df.select("conv_id", "layout", "turns", chat.read_back(F.col("formatted")).alias("back"), "formatted").orderBy("conv_id").collect()
    for r, (_, layout, turns) in zip(got, records, strict=True):
        assert r.layout == layout
        assert (r.turns and [tuple(t) for t in r.turns]) == (turns or (None if turns is None else []))
        if turns is not None:
            assert [(t.role, t.text, t.loss) for t in r.back] == [(a, b, a == "assistant") for a, b in turns]
            assert r.formatted.count(chat.CLOSE) == len(turns)


def test_chat_records_of_rows(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (2, 1, "b", "x"), (2, 1, "a", "y"), (2, None, None, "z"), (None, 0, "user", "n"), (3, 5, "user", "u"), (3, 5, "user", "u")]
    named = [(k, t, role, f"{role} says") for k in (10, 11) for t, role in enumerate(("human", "gpt", "tool", "assistant", "user"))]
    rows += named + [(13, t, role, role) for t, role in enumerate(("user", "assistant", "user"))]
    df = chat.formatted_conversations(chat.conversation_records(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in df.collect()}
    assert got == {1: [("user", "q"), ("assistant", "")], 2: [("", "z"), ("a", "y"), ("b", "x")], None: [("user", "n")], 3: [("user", "u"), ("user", "u")]} | {
        k: [(role, f"{role} says") for role in ("human", "gpt", "tool", "assistant", "user")] for k in (10, 11)} | {13: [("user", "user"), ("assistant", "assistant"), ("user", "user")]}
    assert chat.formatted_conversations(chat.conversation_records(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
    clash = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "conv_id long, turn long, role string, text string, t string, roles string, record string")
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in chat.formatted_conversations(chat.conversation_records(clash)).collect()} == got


def test_chat_query_on_other_roles(spark, tmp_path):
    """Roles human, gpt and tool of a table are read back as they are, and none of them is under the loss mask."""
    duckdb = pytest.importorskip("duckdb")
    rows = [(k, t, role, f"{role} # {k}") for k in range(4) for t, role in enumerate(("human", "gpt", "tool", "user", "assistant")[k:] if k < 3 else ("user", "assistant"))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.SQL10)
    got = queries.op10_chat(spark, str(tmp_path)).select(*want.columns)
    same(got.collect(), want.fetchall())
    assert {r.conv_id: r.loss_chars for r in got.collect()}[0] == len("assistant # 0")


def test_chat_odd_records(spark):
    """Only records of a known shape are mapped."""
    records = ['{"prompt": {"a": 1}, "completion": "x"}', '{"prompt": [1], "completion": "x"}', '{"messages": "[]"}', '{"messages": [1, "a"]}', '{"messages": [{}]}',
               '{"messages": [{"role": "u", "content": {"a": 1}}]}', '{"messages": [{"role": "u", "content": ["a"]}]}', '{"messages": [{"role": "u", "content": "x", "w": 2}]}',
               '{"messages": [{"role": "u"}]}', '{"prompt": "a", "prompt": "b", "completion": "c"}', '{"messages[].content": 1, "messages[].role": 2}',
               '{"messages": [{"role": "u", "role": "v", "content": "x"}]}', "[1]", '{}', '{"messages": [], "x": 1}',
               '{"messages": [null, {"role": "u"}, {"content": "x"}]}', '{"completion": null, "prompt": "{\\"a\\": 2}"}']
    df = chat.with_turns(spark.createDataFrame(list(enumerate(records)), "conv_id long, record string"))
    got = {r.conv_id: (r.layout, r.turns and [tuple(t) for t in r.turns]) for r in df.collect()}
    assert got == {k: (None, None) for k in range(15)} | {15: ("messages", [("", ""), ("u", ""), ("", "x")]), 16: ("prompt", [("user", '{"a": 2}'), ("assistant", "")])}


def test_chat_record_with_a_text_beyond_the_readers_limit(spark):
    record = F.concat(F.lit('{"messages":[{"role":"user","content":"'), F.repeat(F.lit("x"), (F.col("id") + 21_000_000).cast("int")), F.lit('"}]}'))
    df = chat.with_turns(spark.range(1).select(F.col("id").alias("conv_id"), record.alias("record")))
    got = df.select("layout", F.transform("turns", lambda t: F.struct(t["role"], F.length(t["text"]))).alias("t")).first()
    assert got.layout == "messages" and [tuple(t) for t in got.t] == [("user", 21_000_000)]


def test_pipeline_against_plain_version(spark):
    """Every stage of the pipeline on the smallest table, each judged on its own input."""
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    out = corpus_pipeline.quality_rules(spark, docs, SMOKE)
    assert out.columns == docs.columns
    good = {i: t for i, t in rows.items() if not brute.base_failed(t)}
    assert {r.doc_id: r.text for r in out.collect()} == good
    out = corpus_pipeline.near_duplicates(spark, out, SMOKE)
    label = brute.components(list(good.items()), 5)
    one = {i: t for i, t in good.items() if label[i] == i}
    assert out.columns == docs.columns and {r.doc_id: r.text for r in out.collect()} == one
    out = corpus_pipeline.recurring_passages(spark, out, SMOKE)
    left = dict(zip(one, brute.kept_words(one.values()), strict=True))
    clean = {i: " ".join(left[i]) if len(left[i]) < len(brute.words(t)) else t for i, t in one.items()}
    assert out.columns == docs.columns and {r.doc_id: r.text for r in out.collect()} == clean
    mixed = corpus_pipeline.mix_sources(spark, out, SMOKE)
    read = Counter((r.doc_id, r.text) for r in mixed.collect())
    assert mixed.columns == docs.columns and set(read) == set(clean.items()) and max(read.values()) <= 3
    packed = corpus_pipeline.run(spark, SMOKE).collect()
    encode = tokens.encoder(queries.tokenizer_path())
    want = Counter({i: (len(encode(t)) + 1) * read[(i, t)] for i, t in clean.items()})
    have = Counter()
    for r in packed:
        have[r.doc_id] += r.length
    assert have == want
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"


def test_every_text_that_goes_has_a_relative_that_stays(spark):
    """Ids that repeat with unlike texts, and rows without an id."""
    r = random.Random(9)
    one, two, three = ([f"w{r.randrange(10 ** 6)}" for _ in range(60)] for _ in range(3))
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, " ".join([*two, "more"])), (None, " ".join(three)), (None, " ".join(three)), (None, " ".join([*three, "x"])), (7, None), (7, None), (8, "")]
    docs = spark.createDataFrame([(*x, {"a": k}, k) for k, x in enumerate(rows)], "doc_id long, text string, _node map<string,int>, c int")
    out = setsketch.one_of_each(docs)
    got = [(x.doc_id, x.text or "") for x in out.collect()]
    assert out.columns == docs.columns and len(got) == 5
    assert {(1, rows[0][1]), (1, rows[1][1]), (7, ""), (8, "")} < set(got) and sum(i is None and t.split()[:60] == three for i, t in got) == 1


def test_pipeline_on_odd_rows(spark, docs, empty, tmp_path):
    """run() on nulls, repeats, ties, long and empty texts and clashing names, and on a table without rows."""
    for name, table in (("some", docs), ("none", empty)):
        table.write.parquet(str(tmp_path / name / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / name))
        assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(out.columns)
        kept = docs.limit(0) if name == "none" else corpus_pipeline.quality_rules(spark, docs, "")
        kept = setsketch.one_of_each(kept)
        assert {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in kept.select("doc_id").collect()}
    assert out.count() == 0
