"""Hard negatives, secrets and token alignment against brute force, and on odd input."""

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from runnel.llm import alignment, negatives, queries, secret_spans

VECTORS = "vec_id long, embedding array<float>, label int, score double, slot int, anchor string"
DDL = "doc_id long, text string, row string, n_a long, pairs string, spans int, _row int"
BYTES, PATTERN, PIECES = queries.BYTE_TOKENS, public_tokenizers.PATTERN, queries.PIECE_TOKENS
LONG = " ".join(f"word{i % 700} tail{i}" for i in range(20_000))


# -- hard negatives ------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 1, "x") for r in rows], VECTORS)


def whole(vector):
    return [int(np.floor(256 * float(np.float32(x)))) for x in vector]


def brute_negatives(rows, anchors, positives=5, most=3):
    """Every score by hand; missing components are zero, missing ids come last."""
    fit = [
        (i, whole(v), label) for i, v, label in rows
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    late = lambda i: (i is None, i or 0)
    out = []
    for at, (i, v, label) in enumerate(fit):
        if i is None or not anchors(i):
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w, strict=False)), late(j), j, other)
            for k, (j, w, other) in enumerate(fit) if k != at
        ]
        scored.sort(key=lambda s: s[:2])
        for score, _, j, _ in [s for s in scored if s[3] == label][:positives]:
            found = [
                s for s in scored
                if s[3] != label and 50 * -score <= 100 * -s[0] <= 95 * -score
            ]
            out += [(i, j, n + 1, s[2], -score, -s[0]) for n, s in enumerate(found[:most])]
    return sorted(out, key=str)


def mined(df, anchor=None, **more):
    anchor = F.col("vec_id") % 10 == 0 if anchor is None else anchor
    return sorted(map(tuple, negatives.mine_negatives(df, anchor, **more).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_negatives_equal_brute_force(spark, seed):
    """Few different values, so that scores tie; copies, odd lengths and broken rows too."""
    rng = np.random.default_rng(seed)
    rows = [
        (i, [float(x) for x in rng.integers(-2, 4, 6) / 4], int(rng.integers(3)))
        for i in range(300)
    ]
    rows += [rows[0], rows[0], rows[11], (10, [0.5, 0.5], 1), (None, [0.75] * 6, 1), (20, [], 1)]
    rows += [(30, None, 1), (40, [1.0, None], 2), (50, [float("nan")], 0), (60, [1.0], None)]
    rows += [(70, [float("inf"), 1.0], 0), (80, [-1.0] * 6, 2), (90, [0.0] * 6, 1)]
    assert mined(vectors(spark, rows)) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_blocks_do_not_change_negatives(spark, monkeypatch):
    """Many small blocks, and a vector that a third of the rows share."""
    rng = np.random.default_rng(5)
    rows = [
        (i, [1.0, 0.5, 0.25] if i % 3 == 0 else [float(x) for x in rng.random(3)], i % 4)
        for i in range(400)
    ]
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert mined(vectors(spark, rows)) == want
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 7)
    monkeypatch.setattr(negatives, "LEAST_ROWS", 30)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 90)
    monkeypatch.setattr(negatives, "TILE", (3, 11))
    assert mined(vectors(spark, rows)) == want


def test_large_scores_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(np.float32(x)) for x in rng.random(3) * 2e4], i % 2) for i in range(60)]
    assert mined(vectors(spark, rows)) == brute_negatives(rows, lambda i: i % 10 == 0)
    rows = [(i, [x * 200 for x in v], label) for i, v, label in rows]
    assert mined(vectors(spark, rows)) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_of_nothing(spark):
    empty = vectors(spark, []).limit(0)
    assert mined(empty) == []
    assert mined(vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)])) == []
    assert mined(vectors(spark, [(0, [1.0], 1)])) == []
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert negatives.mine_negatives(empty, F.lit(True)).columns == names


# -- secrets -------------------------------------------------------------------------------


def plain_spans(text):
    """The base kinds by their definition, without the operator's shortcuts."""
    word = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")
    any_case = lambda s: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)
    names = "|".join([word, *map(any_case, ("passwd", "secret", "token"))]) + "|" + any_case("api") + "_?" + any_case("key")
    assign = re.compile(rf"({names})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    out = [("assign", *m.span(), True) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span(), True) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", *m.span(), True) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secret_spans.KINDS.index(s[0])))


def tokens_of(s):
    return secret_spans.counter(BYTES, PATTERN)(s)


PARTS = st.sampled_from(
    ["password", "PassWd", "secret", "tOken", "api_key", "APIKEY", "ſecret", "toKen", "AKIA", "a1b2c3d4",
     "0123456789abcdef", "ABCDEF12", "=", ":", "  ", " ", "'", '"', "é", "\n", "-", "x" * 9, "Q7z"]
)


@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_secrets_equal_plain_patterns(text):
    found = secret_spans.find_spans(text, tokens_of)
    assert [s for s in found if s[3]] == plain_spans(text)
    assert found == sorted(found, key=lambda s: (s[1], secret_spans.KINDS.index(s[0])))


def random_spans(text):
    return [text[s[1] : s[2]] for s in secret_spans.find_spans(text, tokens_of) if s[0] == "random"]


def test_random_strings_are_found():
    rng = np.random.default_rng(3)
    letters = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    for size in (20, 24, 32, 40, 64, 200):
        made = ["".join(rng.choice(letters, size)) for _ in range(200)]
        found = sum(bool(random_spans(f"see {s} there")) for s in made)
        assert found >= 196, size
    inside = "plainwords" * 20 + "".join(rng.choice(letters, 64)) + "plainwords" * 20
    assert random_spans(inside)


@pytest.mark.parametrize(
    "text",
    [
        "getHttpResponseCodeFromServerV2", "internal_server_error_code_500",
        "2024-01-02T03-04-05-000Z", "org/apache/spark/sql/execution/datasources/v2",
        "x86_64-unknown-linux-gnu", "AbstractSingletonProxyFactoryBean2", "4532015112830366",
        "123e4567-e89b-12d3-a456-426614174000", "356A192B7913B04C54574D18C28D46E6395428AB",
        "sha256-a4ayc/80/OGda4BO/1o/V0etpOqiLx1JwB5S3beHW0s=", "donaudampfschifffahrtsgesellschaft42",
    ],
)
def test_digests_identifiers_and_names_are_not_random(text):
    assert random_spans(f"see {text} there") == []


def odd(spark, *texts):
    rows = [(i, t, "r", 1, "p", 2, 3) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[1], rows[1], (None, texts[1], *rows[0][2:])], DDL)


def test_secrets_on_odd_input(spark):
    texts = [None, "token = abcdef0123456789abcdef0123", "", LONG + " AKIA" + "Q" * 30]
    df = odd(spark, *texts)
    found = secret_spans.find_secrets(df, BYTES, PATTERN).collect()
    assert len(found) == 7
    by_id = collections.defaultdict(list)
    for r in found:
        by_id[r["row"]["doc_id"]].append([s["kind"] for s in r["spans"]])
    assert by_id == {
        0: [[]], 1: [["assign", "hex"]] * 3, 2: [[]], 3: [["access"]], None: [["assign", "hex"]]
    }
    assert found[0]["row"].asDict().keys() == set(df.columns)
    assert secret_spans.find_secrets(df.limit(0), BYTES, PATTERN).count() == 0


def test_secrets_of_all_documents(spark):
    """The registered query against the plain patterns, row by row."""
    rows = {r["doc_id"]: r for r in queries.op12_secrets(spark, "/root/testdata/sf0.001").collect()}
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want = plain_spans(d["text"] or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in want)
        got = rows[d["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        counts = collections.Counter(k for k, *_ in want)
        assert [got[f"n_{k}"] for k in secret_spans.BASE] == [counts[k] for k in secret_spans.BASE]
        assert set(listed.split(",")) - {""} <= set(got["spans"].split(","))


# -- alignment -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def plain():
    """The tokenizers by their own files, with the bytes of each token."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    # The byte-level alphabet: printable bytes stand for themselves, the others follow 255.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in shown]
    byte_of = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(rest)}

    def a_tokens(text):
        ids = a.encode(text, add_special_tokens=False).ids
        return [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in ids]

    def b_tokens(text):
        out = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            hexed = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            out.append((i, bytes([int(hexed[1], 16)]) if hexed else piece.replace("▁", " ").encode()))
        return out

    return a_tokens, b_tokens


def brute_alignment(texts, plain):
    a_tokens, b_tokens = plain
    docs, counts = [], collections.Counter()
    for text in texts:
        sides = []
        if text:
            for made in (a_tokens(" " + text), b_tokens(text)):
                ends, at = [], 0
                for i, data in made:
                    at += len(data)
                    ends.append((i, at))
                sides.append((b"".join(d for _, d in made), ends))
        if not sides or any(s[0] != (" " + text).encode() for s in sides):
            docs.append(None)
            continue
        (_, a), (_, b) = sides
        common = sorted({e for _, e in a} & {e for _, e in b})
        groups, last = [], 0
        for stop in common:
            inside = [",".join(str(i) for i, e in side if last < e <= stop) for side in (a, b)]
            groups.append("|".join(inside))
            last = stop
        links = [(i, j) for i, e in a for j, f in b if e == f]
        counts.update(links)
        docs.append((len(a), len(b), groups, links))
    best = collections.defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = d
        n_best = sum(counts[x] == best[x[1]] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((n_a, n_b, len(groups), len(links), n_best, sum(counts[x] for x in links), digest))
    return out


ODD_TEXTS = [
    "plain words, plain words", None, "", " ", "  two  spaces ", "a\r\n\tb\n", "▁low line", "ﬁ ｆｕｌｌ Å",
    "<s> <|endoftext|> </s> <unk> <0x41>", "日本語のテキスト", "🙂🙃 zero​width", "\x00\x01", "naïve café Ünïcode",
    "plain words, plain words", "x" * 300, "don't we'll I'm 12345 3.14",
]


def test_alignment_equals_brute_force(spark, plain):
    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    found = alignment.align_corpus(docs, BYTES, PATTERN, PIECES)
    rows = {r["row"]["doc_id"]: r for r in found.collect()}
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = [tuple(rows[i][n] for n in names) for i in range(len(ODD_TEXTS))]
    assert got == brute_alignment(ODD_TEXTS, plain)


def test_both_joins_give_the_same_counts(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    aligned = alignment.align_texts(docs, BYTES, PATTERN, PIECES, carry=["doc_id"])
    aligned = alignment.checkpoint(aligned)
    rows = [
        sorted(map(tuple, alignment.held_against_corpus(aligned, n).collect()))
        for n in (10**9, 0)
    ]
    assert rows[0] == rows[1]
    assert len(rows[0]) == docs.count()


@given(st.lists(st.integers(1, 4), max_size=12), st.lists(st.integers(1, 4), max_size=12))
def test_coalescing_groups_and_overlaps(a, b):
    size = max(sum(a), sum(b))
    a, b = a + [size - sum(a)] * (sum(a) < size), b + [size - sum(b)] * (sum(b) < size)
    a_ends, b_ends = np.cumsum(a).astype(int), np.cumsum(b).astype(int)
    order, group, left, right = alignment.coalesce(a_ends, b_ends)
    common = sorted(set(a_ends) & set(b_ends))
    ends = np.concatenate([a_ends, b_ends])
    assert [int(np.searchsorted(common, ends[i])) for i in order] == group.tolist()
    a_runs = list(zip([0, *a_ends], a_ends, strict=False))
    b_runs = list(zip([0, *b_ends], b_ends, strict=False))
    want = {
        (i, j) for i, (s, e) in enumerate(a_runs) for j, (t, f) in enumerate(b_runs)
        if s < f and t < e
    }
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == want


def test_alignment_on_odd_input(spark):
    df = odd(spark, None, "one two", "", LONG)
    found = alignment.align_corpus(df, BYTES, PATTERN, PIECES).collect()
    assert len(found) == 7
    assert sorted(r["row"]["doc_id"] or -1 for r in found) == [-1, -1, 1, 1, 1, 2, 3]
    one = [r for r in found if r["row"]["text"] == "one two"]
    assert {(r["n_links"], r["n_best"], r["count_sum"]) for r in one} == {(2, 2, 8)}
    assert set(found[0]["row"].asDict()) == set(df.columns)
    assert alignment.align_corpus(df.limit(0), BYTES, PATTERN, PIECES).count() == 0


def test_queries_without_sql_are_named():
    """These need a model, a tokenizer or spans, and have brute-force tests or held-out labels."""
    assert set(queries.QUERIES) - set(queries.ORACLE) == {
        "op1_quality", "op3_urls", "op4_toxicity", "op5_simhash", "op8_html", "op9_pii",
        "op10_packing", "op12_secrets", "op13_alignment",
    }
