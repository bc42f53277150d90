"""The operators against brute force, SQL, held-out labels, and on odd input."""

import collections
import html as html_lib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import _rows, connect
from runnel.llm import (
    decontaminate,
    html,
    packing,
    pii,
    quality,
    queries,
    rules,
    simhash,
    substrings,
    text,
    toxicity,
    urls,
)

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
DDL = (
    "doc_id long, text string, source string, n_chars long, row string, score double, fp long, "
    "n_words int, hits string, _carry int"
)
LONG = " ".join(f"word{i % 700} tail{i}" for i in range(20_000))


def odd(spark, *texts):
    rows = [(i, t, None if i % 3 else "s", None, "r", 0.5, 1, 2, "h", 3) for i, t in enumerate(texts)]
    rows += [rows[1], rows[1], (None, texts[1], "s", 1, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="module")
def strange(spark):
    return odd(spark, None, "one two three four", "", " \n\t ", LONG, "one two three four", LONG + " end")


@pytest.fixture(scope="module")
def nothing(strange):
    return strange.limit(0)


def texts_of(name="documents", column="text", sf=SMALL):
    t = pq.read_table(f"{sf}/{name}.parquet").to_pydict()
    return dict(zip(t["doc_id" if name == "documents" else "page_id"], t[column], strict=True))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    df, con = queries.QUERIES[name](spark, SMALL), connect(SMALL)
    cursor = con.execute(queries.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, cursor.fetchall())


def test_wu_manber_finds_every_occurrence():
    rng = random.Random(4)
    for _ in range(300):
        text = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(60))]
        size = rng.randrange(1, 6)
        patterns = {tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(size)): {"x"} for _ in range(4)}
        found = {at for at, _ in decontaminate.WuManber(patterns, size).search(text)}
        assert found == {i for i in range(len(text) - size + 1) if tuple(text[i : i + size]) in patterns}


def test_decontamination_on_odd_input(spark, strange, nothing):
    bench = spark.createDataFrame(
        [(1, "Two, THREE"), (2, None), (None, "one"), (1, "word5 tail5"), (3, "")], "item_id long, text string"
    )
    found = decontaminate.find_passages(strange, bench)
    got = [(r["row"]["doc_id"], r["n_words"], len(r["item_ids"])) for r in found.collect()]
    assert collections.Counter(got) == collections.Counter(
        [(0, 0, 0), (2, 0, 0), (3, 0, 0), (4, 40_000, 1), (6, 40_001, 1), (5, 4, 1), (None, 4, 1)]
        + [(1, 4, 1)] * 3
    )
    assert found.select("row.*").columns == strange.columns
    blocks = decontaminate.find_passages(strange, bench, block_windows=1)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, found.collect()))
    assert decontaminate.find_passages(nothing, bench).count() == 0
    assert decontaminate.find_passages(strange, bench.limit(0)).where(F.size("hits") > 0).count() == 0


def brute_fingerprint(text):
    low = text.translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    parent = {f: f for f in set(fps.values())}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for f in parent:
        for g in parent:
            if (f ^ g).bit_count() <= 2:
                parent[root(f)] = root(g)
    least = {}
    for i, f in fps.items():
        least[root(f)] = min(i, least.get(root(f), i))
    return {i: least[root(f)] for i, f in fps.items()}


def test_simhash_equals_brute_force(spark):
    found = queries.op5_simhash(spark, SMALL).collect()
    fps = {i: brute_fingerprint(t) for i, t in texts_of().items()}
    components = brute_components(fps)
    assert {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in found} == {
        i: (f, components[i]) for i, f in fps.items()
    }


def test_links_in_crowded_groups(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base ^ (1 << rng.randrange(24)) ^ (1 << rng.randrange(24)) ^ (1 << rng.randrange(40)) for _ in range(400)}
    fps |= {rng.getrandbits(64) for _ in range(300)}
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(sorted(fps))]
    nodes = spark.createDataFrame(signed, "id long, fp long")
    found = simhash.components(simhash.near_pairs(nodes, group=32))
    roots = {r["node"]: r["root"] for r in found.collect()}
    want = brute_components(dict(enumerate(sorted(fps))))
    assert {i: roots.get(i, i) for i in want} == want


def test_near_duplicates_on_odd_input(spark, strange, nothing):
    found = simhash.near_duplicates(strange).collect()
    assert len(found) == 10
    by_id = {r["doc_id"]: r["component_id"] for r in found}
    assert by_id[0] == by_id[2] == by_id[3] == 0 and by_id[5] == by_id[None] == 1
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(strange)
    assert kept.columns == strange.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({by_id[i] for i in range(7)})
    lone = spark.createDataFrame([(None, "x y z")] * 2 + [(None, "p q r s t")], "doc_id long, text string")
    assert simhash.keep_one(lone).count() == 2
    assert {r["component_id"] for r in simhash.near_duplicates(lone).collect()} == {None}


def edited(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"new{rng.randrange(10**9)}"
    return out


def test_stage_keeps_one_of_near_copies(spark):
    rng, texts = random.Random(8), {}
    for size, changes in ((100, 1), (200, 2), (500, 1), (1000, 5), (300, 5), (60, 2), (4, 0), (5, 1)):
        for _ in range(8):
            base = [f"w{rng.randrange(5000)}" for _ in range(size)]
            texts[len(texts)] = " ".join(base)
            for n in range(3):
                texts[len(texts)] = " ".join(edited(rng, base, changes + n if size > 5 else changes))
    chain = [f"c{i}" for i in range(2000)]
    for i in range(60):  # each is a near copy of the next ones only
        texts[len(texts)] = " ".join([*chain[i:], *(f"d{x}" for x in range(i))])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    roots = brute_components({i: brute_fingerprint(t) for i, t in texts.items()})
    assert len(set(roots.values())) < len(texts) - 40
    kept = corpus_pipeline.drop_near_copies(spark, docs, SMALL)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots.values()))
    twice = docs.unionByName(docs.where("doc_id < 3")).unionByName(spark.createDataFrame([(None, "lone")], docs.schema))
    kept = corpus_pipeline.drop_near_copies(spark, twice, SMALL)
    assert kept.count() == len(set(roots.values())) + 1


def test_rules_on_odd_input(strange, nothing):
    found = rules.judge_hosts(strange)
    assert found.count() == 10
    assert found.where("n_words = 0 AND (kept OR NOT base_failed)").count() == 0
    assert rules.judge_hosts(nothing).count() == 0
    assert rules.beta_prior(0.5, 0.25, 0.1) == (0.5, None)
    mean, weight = rules.beta_prior(0.2, 0.08, 0.001)
    assert mean == 0.2 and weight == pytest.approx(0.16 / (0.04 - 0.00016) - 1)


def test_bad_host_is_rejected(spark):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good, "good") for i in range(60)] + [(100 + i, "x" if i % 9 else good, "bad") for i in range(60)]
    found = rules.judge_hosts(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r["row"]["doc_id"] for r in found.where("kept").collect()}
    assert kept == set(range(60))


def test_host_is_rejected_by_the_rule_that_it_fails(spark):
    """No document of these hosts fails by itself; a third of some hosts' fail one rule."""
    good = " ".join(f"w{i}" for i in range(30))
    bad = {
        "signs": good + " ## ||" * 2,
        "lines": "\n".join([good, *["again"] * 4]),
    }
    rows = []
    for h in range(40):
        for i in range(60):
            name = "signs" if h == 7 else "lines" if h == 8 else None
            text = bad[name] if name and i % 3 else bad["signs"] if h < 7 and i == 0 else good
            rows.append((h * 100 + i, text, f"host{h}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = rules.judge_hosts(docs).select("host", "rejected_by", "base_failed", "kept").distinct()
    assert {r["host"]: r["rejected_by"] for r in found.collect() if not r["kept"]} == {
        "host7": ["symbols"], "host8": ["lines"],
    }
    assert found.where("base_failed").isEmpty()


def test_limit_of_a_rate_follows_the_prior():
    assert rules.rate_limit(None, None, 3, (0.25, 0.5)) == 0.5
    assert rules.rate_limit(0.01, 99, 3, (0.25, 0.5)) == 0.25
    assert rules.rate_limit(0.2, 63, 3, (0.25, 0.5)) == pytest.approx(0.35)
    assert rules.rate_limit(0.2, 0, 3, (0.25, 0.5)) == 0.5


def brute_repeats(texts, window=13):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out[i] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = [[f"{rng.choice('abc')}{rng.randrange(9)}" for _ in range(rng.randrange(10, 40))] for _ in range(6)]
    texts = {}
    for i in range(40):
        parts = [rng.choice(passages)[rng.randrange(4) :] if rng.random() < 0.5 else [rng.choice("xyz")] * rng.randrange(20)
                 for _ in range(rng.randrange(6))]
        texts[i] = rng.choice([" ", "\n", "  "]).join(w for p in parts for w in p)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = substrings.remove_repeats(docs).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in found} == brute_repeats(texts)


def test_passage_in_most_documents_is_spread(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("doc")
    )
    keys = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least"))
    found = text.join_spread(rows, keys.where("k % 2 = 0"), ["k"], ["doc"], share=10)
    expected = rows.join(keys, "k").where("k % 2 = 0").select("k", "doc", "least")
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
    assert text.join_spread(rows, keys.where("k < 0"), ["k"], ["doc"]).count() == 0
    shared = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(i, f"a{i} {shared} z{i}") for i in range(300)], "doc_id long, text string")
    got = substrings.remove_repeats(docs).collect()
    assert {(r["doc_id"], r["n_removed"]) for r in got} == {(i, 20 if i else 0) for i in range(300)}


def test_repeats_on_odd_input(spark, strange, nothing):
    found = substrings.remove_repeats(strange).collect()
    by = collections.Counter((r["doc_id"], r["n_words"], r["n_removed"]) for r in found)
    assert by == collections.Counter(
        [(0, 0, 0), (2, 0, 0), (3, 0, 0), (4, 40_000, 0), (5, 4, 0), (6, 40_001, 40_000), (None, 4, 0)]
        + [(1, 4, 0)] * 3
    )
    assert substrings.remove_repeats(nothing).count() == 0
    run = " ".join(f"w{i}" for i in range(15))
    twice = spark.createDataFrame([(1, run), (1, "a " + run), (2, run)], "doc_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_removed"]) for r in substrings.remove_repeats(twice).collect()]
    assert sorted(got) == [(1, 15, 0), (1, 16, 0), (2, 15, 15)]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in double) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }
            if good[kind]:
                out.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


def test_spans_equal_plain_patterns():
    rng, anchors = random.Random(7), pii.automaton()
    for _ in range(20_000):
        text = "".join(rng.choice("aZ9@@..+-  ()0123456789é%_\n") for _ in range(rng.randrange(60)))
        assert [s[:3] for s in pii.find_spans(text, anchors) if s[3]] == brute_spans(text)
    for text in texts_of().values():
        assert [s[:3] for s in pii.find_spans(text, anchors) if s[3]] == brute_spans(text)


def test_added_spans_and_masks():
    anchors = pii.automaton()

    def kinds(text):
        return [(s[0], text[s[1] : s[2]]) for s in pii.find_spans(text, anchors)]

    assert kinds("IBAN DE89 3704 0044 0532 0130 00.") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("IBAN DE88 3704 0044 0532 0130 00.") == []
    assert kinds('token = "24be64439e3e49"') == [("account", "24be64439e3e49")]
    assert kinds("tokenize = 123456789") == []
    text = "a é mail x.y@z.org or +1 (017) 555-7713"
    spans = [(s[1], s[2], s[0]) for s in pii.find_spans(text, anchors)]
    assert pii.mask(text, spans) == "a é mail [EMAIL] or [PHONE]"


def test_personal_data_on_odd_input(strange, nothing):
    assert pii.personal_data(strange).where(F.size("spans") == 0).count() == 10
    assert pii.masked(strange).where(F.col("clean").eqNullSafe(F.col("row.text"))).count() == 10
    assert pii.personal_data(nothing).count() == 0


def test_packing_round_trip(spark, nothing, strange):
    found = queries.op10_packing(spark, SMALL).toPandas()
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for doc, text in texts_of().items():
        ids = np.array([*encoder.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[(doc, piece)] = (at, len(part), zlib.crc32(part.tobytes()))
    rows = zip(*(found[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")), strict=True)
    assert {(d, p): (s, n, c) for d, p, s, n, c in rows} == want
    check_places(found)
    assert found.sequence_id.nunique() <= -(-found.length.sum() // 2048) + 1
    assert packing.pack_documents(nothing, queries.TOKENIZER).count() == 0
    assert packing.pack_documents(strange, queries.TOKENIZER).where("piece = 0").count() == 10


def test_ids_are_those_of_whole_texts():
    """Also with strings of special tokens, other white space and letters outside ASCII."""
    encoder = Tokenizer.from_file(queries.TOKENIZER)
    texts = [
        "a <|startoftext|> b", "x<|endoftext|>y <|STARTOFTEXT|>", "don't WE'LL 'standard it's 'S",
        "tab\tand\u00a0space  two\n\nlines\r\n", "Ünïcödé ΣΑΣ İstanbul H\u0331 h\u0331 ﬁ", "日本語 🙂", "", " ",
        "a1b22 3.14 ...!? (x) <|", "\x00 \x01", "ǅ K ſ", "e\u0301 E\u0301",
    ]
    want = [encoder.encode(t, add_special_tokens=False).ids for t in texts]
    made = packing.Tokens(queries.TOKENIZER).of(texts)
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == want


def test_fast_coder_gives_the_same_ids():
    """All words of the documents, and random ones of frequent letters and signs."""
    rng = random.Random(8)
    words = sorted({w for t in texts_of(sf=MIDDLE).values() for w in (t or "").split()})
    for letters, most in (("etaoinshr", 20), ("abcdefghijklmnopqrstuvwxyzABC'',.!?-0123456789\t", 14)):
        words += ["".join(rng.choices(letters, k=rng.randrange(1, most))) for _ in range(20_000)]
    coder = packing.Tokens(queries.TOKENIZER)
    assert coder.fast is not None
    made = coder.of(words)
    plain = packing.Tokens(queries.TOKENIZER)
    plain.fast = None
    assert made == plain.of(words)


def check_places(found, most=2048):
    ordered = found.sort_values(["sequence_id", "offset"])
    groups = ordered.groupby("sequence_id").length
    assert (groups.cumsum() - ordered.length == ordered.offset).all()
    assert groups.sum().max() <= most


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_plan_keeps_every_limit(rule):
    rng = random.Random(3)
    for _ in range(30):
        counts = {rng.randrange(1, 101): rng.randrange(1, 300) for _ in range(rng.randrange(1, 30))}
        limits = packing.Limits(100, rng.choice([None, 3]), rng.choice([None, 10_000]))
        places, made = packing.plan(counts, limits, rule, (1.0, 0.2, 0.2))
        bins = collections.defaultdict(list)
        for length, first, last, lowest, each, used in places:
            for rank in range(last - first):
                bins[lowest + rank // each].append((used + rank % each * length, length))
        assert sum(map(len, bins.values())) == sum(counts.values()) and len(bins) == made
        for held in bins.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            assert at <= 100 and len(held) <= limits.vector[1]
            assert sum(n * n for _, n in held) <= limits.vector[2]


def test_toxicity_on_held_out_labels(spark):
    found = queries.op4_toxicity(spark, MIDDLE).toPandas()
    labels = pq.read_table(f"{MIDDLE}/labels.parquet").to_pandas()
    assert found.score.between(0, 1).all()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    clean, toxic = held[held.toxic == 0], held[held.toxic == 1]
    assert clean.predicted.mean() < 0.02 and toxic.predicted.mean() > 0.3
    assert np.mean([(clean.score < s).mean() for s in toxic.score]) > 0.85


def test_toxicity_on_odd_input(spark, strange, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    for some in (labels, labels.limit(0)):
        model = toxicity.learn(strange, some)
        scored = toxicity.score_texts(strange, model)
        assert scored.where("score BETWEEN 0 AND 1").count() == 10
        assert toxicity.score_texts(nothing, model).count() == 0
    assert toxicity.learn(nothing, labels).curve.score(np.zeros((1, len(toxicity.FEATURES))))[0] < 0.5


def test_quality_on_labels_it_has_not_seen(spark):
    found = queries.op1_quality(spark, MIDDLE).toPandas()
    labels = pq.read_table(f"{MIDDLE}/labels.parquet").to_pandas()
    both = found.merge(labels, on="doc_id")
    assert both[both.quality == 1].kept.mean() > 0.97
    assert both[both.quality == 0].kept.mean() < 0.15


def test_em_finds_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.7
    right = np.array([0.95, 0.85, 0.7, 0.8, 0.9])
    votes = np.where(rng.random((20_000, 5)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.3] = quality.SILENT
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = quality.expectation_maximisation(patterns, counts.astype(float))
    assert found.share == pytest.approx(0.7, abs=0.02)
    assert found.table[:, 1, 1] == pytest.approx(right, abs=0.03)
    assert found.table[:, 0, 0] == pytest.approx(right, abs=0.03)


def test_quality_on_odd_input(strange, nothing):
    found = quality.classify(strange)
    assert found.where("score BETWEEN 0 AND 1 AND posterior BETWEEN 0 AND 1").count() == 10
    assert quality.classify(nothing).count() == 0


def test_urls_follow_the_rules(spark):
    found = queries.op3_urls(spark, MIDDLE).toPandas()
    given = texts_of("pages", "url", MIDDLE)
    for r in found.itertuples():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", given[r.page_id])
        host, path = m[1].lower(), m[2]
        fits = [
            (len(rule.name), rule.name, rule.verdict) for rule in urls.RULES
            if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
        ]
        assert (r.host, r.path) == (host, path)
        if fits:
            assert (r.rule, r.verdict) == max(fits)[1:]
    free = found[found.rule.isna()]
    spam = free.host.str.contains("pills|casino|bets|spam|ads-|adult")
    assert (free[spam].verdict == "block").mean() > 0.9
    assert (free[~spam].verdict == "allow").mean() > 0.95


def test_urls_on_odd_input(spark):
    odd_urls = [None, "", "no scheme", "HTTP://Org", "x://a.ORG?q", "://", "http://b.com/de/x#y", "http://b.com/de"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(odd_urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(pages).collect()}
    assert got[0] == got[2] == got[5] == ("", "", None, "allow")
    assert got[3] == ("org", "", None, "allow") and got[4][:2] == ("a.org", "")
    assert got[6] == ("b.com", "/de/x", "com/de/", "block") and got[7][2] is None
    assert urls.judge_urls(pages.limit(0)).count() == 0


def made_urls(rng, ordinary, listed, hidden, kinds=10**9):
    """Ordinary URLs, spam on hosts with a listed word, and spam on hosts without one.

    ``kinds`` is the number of different paths that spam has.
    """
    def letters(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    def spam(lead):
        path = random.Random(rng.randrange(kinds)).choices("qxzjkvwy", k=18)
        return f"http://{lead}{letters('qxzjkv', 6)}.net/{''.join(path)}"

    out = [f"http://{letters('aeiost', 6)}.net/{letters('aeiorn', 9)}/{rng.randrange(999)}" for _ in range(ordinary)]
    return out + [spam("casino-") for _ in range(listed)] + [spam("") for _ in range(hidden)]


def judged(spark, given):
    pages = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    return urls.judge_urls(pages, rules=()).toPandas().sort_values("page_id")


def test_urls_do_not_vote_for_themselves(spark):
    found = judged(spark, made_urls(random.Random(3), 4000, 300, 30))
    assert (found.verdict[:4000] == "block").mean() < 0.01
    assert (found.verdict[4300:] == "block").mean() > 0.8


def test_url_threshold_counts_every_row(spark):
    given = made_urls(random.Random(4), 24_000, 3000, 900, 1000)
    column = spark.createDataFrame([(u,) for u in given[:24_000]], "u string")
    key = F.regexp_replace("u", "^http://", "")  # also least by the hash without the scheme
    least = column.orderBy(F.xxhash64(key)).first()[0]
    found = judged(spark, given + [least] * 12_000)
    accepted = found[~found.host.str.startswith("casino")]
    assert 0.009 < (accepted.verdict == "block").mean() <= 0.01


def test_url_runs_do_not_share_counts():
    codes, at, _ = urls._codes(made_urls(random.Random(5), 20_000, 0, 20_000))
    runs = {bytes(codes[i - 5 : i + 1].astype("<u4").tobytes()) for i in at.tolist()}
    assert len(runs) > 200_000
    assert len(np.unique(urls._hashes(codes, at + 1, 6, 10))) == len(runs)


def test_whole_url_is_judged(spark):
    given = made_urls(random.Random(6), 500, 50, 0)
    found = judged(spark, [*given, "http://a.net/b?page=2", "http://a.net/b?qxzjkv#vq", "no scheme", "qxzjkvqxz", None])
    last = found.ratio.tolist()[-5:]
    assert len(set(last)) == 5
    assert found.host.tolist()[-3:] == [""] * 3 and found.path.tolist()[-5:-3] == ["/b"] * 2


def test_letter_runs_do_not_share_counts(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(14)) for _ in range(40_000)]
    lines = [(" ".join(words[i : i + 100]).encode(), i % 2, 0) for i in range(0, len(words), 100)]
    found = toxicity.run_counts(spark.createDataFrame(lines, "text binary, toxic int, fold int"))
    got = {r["kind"]: r["n"] for r in found.groupBy("kind").agg(F.count("key").alias("n")).collect()}
    marked = ["\x02" * 5 + w + "\x03" for w in words]
    top = {w[i : i + 6] for w in marked for i in range(len(w) - 5)}
    assert len(top) > 200_000 and got[toxicity.RUN] == len(top)
    assert got[toxicity.CONTEXT] == len({t[:5] for t in top})
    assert got[15] == len({t[1:] for t in top})


def test_main_text_of_all_pages(spark):
    found = {r["page_id"]: r["text"] for r in queries.op8_html(spark, MIDDLE).collect()}
    for page, raw in texts_of("pages", "html", MIDDLE).items():
        body = re.search(r"(?s)<article>(.*?)(</article>|\Z)", raw)[1]
        blocks = [" ".join(html_lib.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert found[page] == "\n".join(b for b in blocks if b)


def test_labeller_gradients():
    model = html.Labeller.new(1)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2, 4, html.INPUTS)).astype(np.float32)
    size, y = np.array([4, 2]), rng.integers(0, 2, (2, 4)).astype(np.float32)
    on = np.arange(4)[None, :] < size[:, None]

    def loss():
        p = model.predict(x, size)
        return -(np.where(y == 1, np.log(p), np.log(1 - p)) * on).sum() / on.sum()

    for w, g in zip(model.weights(), model.gradients(x, size, y, on), strict=True):
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, step = w[i], 1e-2
        w[i] = kept + step
        up = loss()
        w[i] = kept - step
        down = loss()
        w[i] = kept
        assert (up - down) / (2 * step) == pytest.approx(g[i], rel=0.05, abs=1e-4)


def test_html_on_odd_input(spark):
    odd_pages = [None, "", "<", "<<p>a", "<p>x" * 3, "<!-- never closed", "<script>1", "a &amp;\u00a0 b", "<a " * 2000]
    odd_pages += ["<article>" + "<p>one two</p>" * 3000 + "</article>"]
    pages = spark.createDataFrame([(i, p, "m") for i, p in enumerate(odd_pages)], "page_id long, html string, main string")
    found = {r["row"]["page_id"]: r["main"] for r in html.main_text(pages).collect()}
    assert found[0] == found[1] == found[5] == found[6] == ""
    assert found[9] == "\n".join(["one two"] * 3000)
    assert html.main_text(pages.limit(0)).count() == 0


def test_pipeline_takes_decisions(spark):
    docs = queries.table(spark, SMALL, "documents")
    columns, kept = docs.columns, docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = kept.count()
        kept = stage(spark, kept, SMALL).cache()
        assert kept.columns == columns and kept.count() <= before
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SMALL).toPandas()
    check_places(packed)
    assert set(packed.doc_id) == {r["doc_id"] for r in kept.select("doc_id").collect()}
    components = brute_components({i: brute_fingerprint(t) for i, t in texts_of().items()})
    assert len({components[i] for i in packed.doc_id}) == packed.doc_id.nunique()
    texts = [r["text"] for r in kept.collect()]
    assert not any(re.search(PATTERNS["email"], t) for t in texts)


def test_pipeline_on_odd_input(spark, strange, nothing):
    for docs, most in ((strange, 10), (nothing, 0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SMALL).count() <= max(most, 1_000 * most)


def brute_ratio(text, accepted, rejected):
    """The Markov ratio from plain counts of strings."""
    lead = "\x02" * (urls.ORDER - 1)

    def probability(examples, context, char):
        p = 1 / 128
        for k in range(urls.ORDER):
            end = context[len(context) - k :]
            runs = [(lead + e + "\x03")[i - k : i + 1] for e in examples for i in range(len(lead), len(lead + e) + 1)]
            total = sum(r[:-1] == end for r in runs)
            p = (sum(r == end + char for r in runs) + urls.PRIOR * p) / (total + urls.PRIOR)
        return p

    whole = lead + text + "\x03"
    logs = [
        math.log(probability(accepted, whole[:i], whole[i]) / probability(rejected, whole[:i], whole[i]))
        for i in range(len(lead), len(whole))
    ]
    return sum(logs) / len(logs)


def test_url_ratios_equal_brute_force(spark):
    rng = random.Random(8)
    made = ["".join(rng.choice("ab/") for _ in range(rng.randrange(9))) for _ in range(60)]
    rows = [(u, len(u) % 2, i % urls.FOLDS) for i, u in enumerate(made)]
    model = urls.learn(spark.createDataFrame(rows, "text string, rejected long, fold long"))
    for fold in (0, 5):
        others = [(u, r) for u, r, f in rows if f != fold]
        parts = [[u for u, r in others if r == c] for c in (0, 1)]
        asked = ["", "ab/ab", "zz", *made[:5]]
        want = [brute_ratio(u, *parts) for u in asked]
        assert np.allclose(model.ratios(asked, fold), want, atol=1e-9)


def brute_weight(word, ordinary, toxic):
    """Kneser-Ney difference of a word from plain counts of letter runs."""
    n, start, stop = toxicity.ORDER, chr(toxicity.START), chr(toxicity.STOP)

    def runs(words, size):
        whole = [start * (n - 1) + w + stop for w in words]
        return [w[i + 1 - size : i + 1] for w in whole for i in range(n - 1, len(w))]

    def discounted(count, total, kinds, lower):
        if not total:
            return lower
        return max(count - toxicity.DISCOUNT, 0) / total + min(toxicity.DISCOUNT * kinds / total, 1) * lower

    def shared(context, char):
        p = 1 / 256
        for k in range(1, n):
            longer = set(runs(ordinary + toxic, k + 1))
            end = context[len(context) - k + 1 :]
            count = sum(r[1:] == end + char for r in longer)
            total = sum(r[1:-1] == end for r in longer)
            kinds = len({r[-1] for r in runs(ordinary + toxic, k) if r[:-1] == end})
            p = discounted(count, total, kinds, p)
        return p

    whole, out = start * (n - 1) + word + stop, 0.0
    for i in range(n - 1, len(whole)):
        context, char = whole[i - n + 1 : i], whole[i]
        lower = shared(context, char)
        for words, sign in ((ordinary, -1), (toxic, 1)):
            held = [r for r in runs(words, n) if r[:-1] == context]
            p = discounted(held.count(context + char), len(held), len(set(held)), lower)
            out += sign * math.log(max(p, 1e-12))
    return out


def test_word_weights_equal_brute_force(spark):
    rng = random.Random(9)
    made = [["".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(40)] for _ in range(2)]
    rows = [(" ".join(words).encode(), toxic, 0) for toxic, words in enumerate(made)]
    counts = toxicity.run_counts(spark.createDataFrame(rows, "text binary, toxic int, fold int")).collect()
    numbers = np.array([[r[c] for c in ("kind", "key", *toxicity.CELLS)] for r in counts], dtype=np.int64)
    tables = toxicity._tables(numbers, [[0, 2], [1, 3]])
    asked = ["a", "zzz", "abéabéabé", *made[0][:6], *made[1][:6]]
    got = tables.weights([w.encode() for w in asked])
    assert np.allclose(got, [brute_weight(w, *made) for w in asked], atol=1e-9)
