"""The training-data operators against brute force, round trips and hand-made edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxstrata.llm import attention_lm, components, lm_scoring, media, merkle, mixing, packing, quality, ranks, secret_scan, sharding, simhash, token_files
from voxstrata.llm.subwords import Subwords, vocabulary_path

SCHEMA = "doc_id long, text string, source string, lang string, bucket int, key string, fp long"
LONG = "word " * 30_000 + "token = \"0123456789abcdef0123\" end."
ROWS = [
    (1, "the quick brown fox, jumps over the lazy dog. Again and again", "b", "en"),
    (2, "the quick brown fox, jumps over the lazy dog. Again and again", "b", "en"),
    (3, None, "a", None),
    (4, "", None, "en"),
    (5, LONG, "a", "de"),
    (None, "no id here, but text", "c", "en"),
    (7, "A\nB\n\nC. D, E", "a", "en"),
    (7, "A\nB\n\nC. D, E", "a", "en"),
    (9, "Straße und  Öl \t x <|endoftext|> y", "", "de"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns with names the operators use."""
    return spark.createDataFrame([(*r, None, "x", 0) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_ids_are_the_library_s(name):
    s = Subwords(vocabulary_path(name), limit=50)
    parts, rnd = [" ", "  ", "\n", "a", "Bé,", "'s", "<|endoftext|>", "\x1c", "\u0301", "12", "!!", "\t", "\x85", "\xa0", "word.", "ß;", "İ.", "'", "×", "÷", "?'s", "\r\n", "1a", "<", "\u0338", "你", " \n", "K", "Σ"], random.Random(1)
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(6000)]
    texts += ["".join(rnd.choice([chr(rnd.randint(0xC0, 0x17F)), *" .'\n1a"]) for _ in range(10)) for _ in range(2000)]
    for got, text in zip(s.encode(texts), texts, strict=True):
        assert np.array_equal(got, s.whole(text)), repr(text)


def test_token_files(docs, none):
    got = token_files.token_files(docs, vocabulary_path("word_bpe_49k.json")).collect()
    s, at = Subwords(vocabulary_path("word_bpe_49k.json")), 0
    rows = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    for r, (key, text, *_) in zip(sorted(got, key=lambda r: r.start), rows, strict=True):
        ids = np.append(s.whole(text or ""), 2).astype("<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (key, at, len(ids), zlib.crc32(ids.tobytes()))
        at += r.n_tokens
    assert token_files.token_files(none, vocabulary_path("word_bpe_49k.json")).count() == 0


def test_wide_ids_refuse_narrow_files(docs, tmp_path, monkeypatch):
    path = vocabulary_path("word_bpe_49k.json")
    assert token_files.id_width(path, 2) == 2 and token_files.id_width(path, 1 << 16) == 4
    monkeypatch.setattr(token_files, "id_width", lambda *_: 1)
    with pytest.raises(Exception, match="doesn't fit"):
        token_files.write_token_files(docs, f"file://{tmp_path}", path, 2)


def test_packing(docs, none):
    path = vocabulary_path("byte_bpe_50k.json")
    s = Subwords(path)
    want = sorted((r[0] is None, r[0] or 0, np.append(s.whole(r[1] or ""), 2).astype("<u4").tobytes()) for r in ROWS)
    got = packing.pack_documents(docs, path, 64, group_pieces=50, keep_ids=True).collect()
    made = {}
    for r in sorted(got, key=lambda r: r.piece):
        assert r.ids_crc32 == zlib.crc32(r.ids) and 4 * r.length == len(r.ids) and r.length <= 64
        if r.doc_id != 7:  # repeated rows can't be told apart
            assert 4 * r.start == len(made.get(r.doc_id, b"")) and (r.piece == 0 or r.length == 64)
            made[r.doc_id] = made.get(r.doc_id, b"") + r.ids
    assert sorted((k is None, k or 0, v) for k, v in made.items()) == [x for x in want if x[1] != 7]
    assert sum(r.length for r in got) == sum(len(x[2]) // 4 for x in want)
    for rows in {r.sequence_id: [x for x in got if x.sequence_id == r.sequence_id] for r in got}.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert packing.pack_documents(none, path, 64).count() == 0


def least_bins(sizes, capacity):
    """By trying all: pieces in falling order into every different bin."""
    sizes, best = sorted(sizes, reverse=True), len(sizes)

    def put(i, fills):
        nonlocal best
        if len(fills) >= best:
            return
        if i == len(sizes):
            best = len(fills)
            return
        for x in {f for f in fills if f + sizes[i] <= capacity}:
            rest = list(fills)
            rest.remove(x)
            put(i + 1, [*rest, x + sizes[i]])
        put(i + 1, [*fills, sizes[i]])

    put(0, [])
    return best


@pytest.mark.parametrize("seed", range(30))
def test_search_is_near_the_optimum(seed):
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, 20, rnd.integers(1, 11))
    end = packing.exchange(lengths, np.arange(len(lengths)), 20)
    fill = np.bincount(end, lengths)
    assert fill.max() <= 20 and (fill > 0).sum() <= least_bins(lengths.tolist(), 20)


@pytest.mark.parametrize("seed", range(4))
def test_exchanges_raise_squared_fill(seed):
    rnd = np.random.default_rng(seed)
    lengths = rnd.integers(1, 100, 2000)
    start = np.arange(2000) // 2  # a poor packing: two to a bin where they fit
    start = np.where(np.bincount(start, lengths)[start] > 100, 2000 + np.arange(2000), start)
    end = packing.exchange(lengths, start, 100)
    fill = lambda b: np.bincount(b, lengths)
    assert fill(end).max() <= 100 and (fill(end) ** 2).sum() >= (fill(start) ** 2).sum()
    assert (fill(end) > 0).sum() < (fill(start) > 0).sum()
    alone = fill(packing.exchange(lengths, np.arange(2000), 100))
    assert (alone > 0).sum() <= 1.02 * math.ceil(lengths.sum() / 100) + 1


def test_simhash_groups(docs, none):
    got = simhash.near_duplicates(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(ROWS) and by[1].component_id == by[2].component_id == 1 and by[3].component_id == by[4].component_id == 3
    assert by[3].fingerprint == "0" * 16 and by[None].component_id is None
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("tile_rows,keep", [(1024, 1), (20, 1), (1024, 2)])
def test_links_equal_brute_force(spark, tile_rows, keep):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(25)]
    fps = {b ^ sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, 6))) for b in base for _ in range(6)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    roots = {r.node: r.root for r in components.components(simhash.links(df, 4, keep, tile_rows)).collect()}
    parent = {signed(x): signed(x) for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                x, y = find(signed(a)), find(signed(b))
                parent[max(x, y)] = min(x, y)
    assert all(roots.get(x, x) == find(x) for x in parent)


def test_secret_spans(docs, none, spark):
    found = {r.doc_id: r for r in secret_scan.span_digests(secret_scan.scan(docs)).collect()}
    assert (found[5].n_assign, found[5].n_hex) == (1, 1) and found[3].spans == "" and found[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    key = "ghp" + "16C7e42F292c6912E7710c838347Ae178B4a"
    more = spark.createDataFrame([(1, f"see {key} and getUserAccountBalanceHistoryIndex", "a")], "doc_id long, text string, source string")
    assert secret_scan.span_digests(secret_scan.scan(more)).first().spans == f"markov:4:{4 + len(key)}"
    clean = secret_scan.redacted(more).first()
    assert clean.text.startswith("see [SECRET] and getUser") and clean.source == "a"
    assert secret_scan.scan(none).count() == 0


def test_base_spans_equal_a_plain_scan():
    rnd = random.Random(8)
    parts = ["password", "PassWord", "api_key", "apikey", "token", "secret", '"', "'", " ", "  ", ":", "=", "AKIA", "AKIAAKIA", "A1B2", "deadbeef", "0123456789abcdef", "+/", "_", ".", "-", "ä", "K", "ſecret", "\n", "x" * 12, "AB" * 7]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
        want = [(m.start(), m.end(), "assign") for m in re.finditer(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 12]
        want += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        want += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
        assert secret_scan.base_spans(text) == sorted(want, key=lambda s: (s[0], secret_scan.KINDS.index(s[2]))), text


def test_secrets_that_no_pattern_knows(spark):
    text = [(i, " ".join(random.Random(i).choice("the of and house water light morning".split()) for _ in range(50))) for i in range(50)]
    ratios = secret_scan.train(spark.createDataFrame(text, "doc_id long, text string")).ravel()
    rnd = random.Random(9)  # neither these keys nor these words are among the training samples
    letters = secret_scan.ALPHABET[:62]
    words = "account balance history panel render manager factory builder customer order invoice payment".split()
    spans = lambda t: secret_scan.model_spans(t, ratios, secret_scan.base_spans(t))
    hit = wrong = 0
    for _ in range(200):
        key = "".join(rnd.choice(letters) for _ in range(rnd.choice((16, 20, 32))))
        line = rnd.choice(("see {} now", "path/to/auth={}", "my-service-name-{}.", "{}")).format(key)
        hit += any(a <= line.index(key) and line.index(key) + len(key) <= b for a, b, _ in spans(line))
        some = [rnd.choice(words) for _ in range(rnd.randint(2, 5))]
        wrong += bool(spans(rnd.choice(("_".join(some), "".join(w.title() for w in some), "/".join(some), "-".join(some) + "7"))))
    assert hit >= 190 and wrong <= 12, (hit, wrong)
    line = "x deadbeef00112233 Zk9QvT7bLr2XwM4c"  # a base span keeps its own, what stands beside it is judged
    found = spans(line)
    assert secret_scan.base_spans(line) and all(b <= line.index("dead") or a >= line.index(" Zk9") for a, b, _ in found) and found


def test_merkle(docs, none, spark):
    got = {r.doc_id: r for r in merkle.edited_fingerprints(docs.filter("doc_id IS NULL OR doc_id != 7")).collect()}
    order = [(9, ROWS[8][1]), (5, LONG), (4, ""), (3, ""), (2, ROWS[1][1]), (1, ROWS[0][1]), (None, ROWS[5][1])]
    for (key, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        assert got[key].edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
    assert got[1].fingerprint == got[2].fingerprint and got[2].near_next == 1.0 and got[5].near_next == 0.0
    assert merkle.edited_fingerprints(none).count() == 0
    one = merkle.edited_fingerprints(docs.filter("doc_id = 9")).first()
    assert one.near_next == 1.0


def merkle_tree(text):
    """The fingerprint by a plain reading of its definition."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    sections = [[]]
    for line in text.split("\n"):
        cuts = [0, *(i for i in range(1, len(line)) if line[i - 1] in ".!?;:,|" and line[i] in " \t\x0b\f\r"), len(line)]
        leaves = [sha(line[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        paragraph = sha(" ".join(leaves))
        sections[-1].append((paragraph, " ".join("l" + x[:16] for x in leaves)))
        if paragraph[0] in "01":
            sections.append([])
    sections = [s for s in sections if s]
    digests = [sha(" ".join(f"p{p} {x}" for p, x in s)) for s in sections]
    tree = " ".join(f"s{d[:16]} " + " ".join(f"p{p[:16]} {x}" for p, x in s) for d, s in zip(digests, sections, strict=True))
    return f"{sha(' '.join(digests))} {tree}"


def test_merkle_equals_plain_tree(spark):
    rnd = random.Random(5)
    texts = ["", "\n", "a.\n\n", "one two. three", "one two.   three", "one two.\tthree", "one two.\n three", ". . .", "x,", "ä! ö? \u2003z", LONG]
    texts += ["\n".join("".join(rnd.choice(["a", "bc", ". ", ", ", "  ", "|", "! "]) for _ in range(rnd.randint(0, 12))) for _ in range(rnd.randint(1, 40))) for _ in range(150)]
    rows = merkle.with_fingerprint(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), "text", "f").collect()
    assert all(r.f == merkle_tree(r.text) for r in rows)
    assert len({r.f.split()[0] for r in rows}) == len(set(texts))  # roots test equality
    pairs = spark.createDataFrame([(merkle_tree(a), merkle_tree(b)) for a, b in zip(texts, texts[1:], strict=False)], "a string, b string")
    for r in pairs.select("a", "b", merkle.likeness(F.col("a"), F.col("b")).alias("near"), merkle.changed(F.col("a"), F.col("b")).alias("at")).collect():
        nodes = lambda f, kind: [x for x in f.split() if x[0] == kind]
        x, y = ({n for n in nodes(f, "l")} for f in (r.a, r.b))
        assert abs(r.near - (1.0 if r.a == r.b else 2 * len(x & y) / (len(x) + len(y)))) < 1e-12
        assert r.at == [i for i, n in enumerate(nodes(r.a, "p")) if n not in nodes(r.b, "p")]


def test_mixing(docs, none, spark):
    got = mixing.mixed(docs).collect()
    assert len(got) == len(ROWS) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert mixing.mixed(none).count() == 0
    assert mixing.mixed(docs.filter("text = ''")).first().taken == 0
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 50), (None, 40)], "source string, source_size long")
    t = {r.source: r.target for r in mixing.weighted_targets(sizes, (5, 2, 1), 1.5, 2).collect()}
    # weights 5, 2, 1, 5 share 300; b stops at 20, None at 80, then a at 5/6 of 200
    assert t["b"] == 20 and t[None] == 80 and abs(t["a"] - 200 * 5 / 6) < 1e-9 and abs(t["c"] - 200 / 6) < 1e-9


def test_hilbert_curve_is_one(spark):
    cells = spark.range(512).selectExpr("id % 8 AS a", "(id DIV 8) % 8 AS b", "id DIV 64 AS c")
    rows = sorted(sharding.hilbert_index(cells, ["a", "b", "c"], 3, "h").collect(), key=lambda r: r.h)
    assert [r.h for r in rows] == list(range(512))
    assert all(sum(abs(x - y) for x, y in zip(p[:3], q[:3], strict=True)) == 1 for p, q in zip(rows, rows[1:]))


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards(docs, none, law):
    got = sharding.document_shards(docs, 3, law=law).collect()
    assert len(got) == len(ROWS)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    if law == "rows":
        assert max(Counter(r.shard for r in got).values()) - min(Counter(r.shard for r in got).values()) <= 1
    assert sharding.document_shards(none, 3, law=law).count() == 0


def test_ranks_by_binary_search(spark):
    cut = [-5, 0, 7, 7 + (1 << 40)]
    df = spark.createDataFrame([(x,) for x in (-9, -5, -4, 0, 1, 8, 1 << 50, None)], "v long")
    assert [r[1] for r in df.select("v", ranks.below("v", cut)).collect()] == [0, 0, 1, 1, 2, 3, 4, 0]


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1024, 5000])
def test_media_round_trip(n):
    data = media.padded(random.Random(n).randbytes(n))
    file = media.mux(data)
    assert media.payload(file) == data
    (f,) = media.features(file)["tracks"]
    assert f["handler"] == "soun" and f["codec"] == "raw " and f["duration"] == len(data) and sum(k["length"] for k in f["keyframes"]) == len(data)
    assert [k["time"] for k in f["keyframes"]] == list(range(0, len(data), 1024))
    assert media.features(file[:-9])["problem"] and media.features(b"")["problem"]


def test_media_tracks_stand_apart():
    file = media.mux(media.padded(bytes(range(256)) * 9))
    moov = next((a, b) for path, a, b in media.walk(file) if path == (b"moov",))
    one = next(file[a - 8 : b] for path, a, b in media.walk(file) if path == (b"moov", b"trak"))
    at = one.index(b"stss") - 4
    size = int.from_bytes(one[at : at + 4], "big")
    picture = one[:at] + media.box(b"free", one[at + 8 : at + size]) + one[at + size :]  # without stss: every sample is a key frame
    picture = picture.replace(b"soun", b"vide").replace(b"raw ", b"avc1")
    both = media.features(file[: moov[0] - 8] + media.box(b"moov", one + picture))["tracks"]
    assert [t["codec"] for t in both] == ["raw ", "avc1"] and both[1]["channels"] is None
    assert [len(t["keyframes"]) for t in both] == [3, 36] and both[0]["samples"] == both[1]["samples"] == 36


def test_media_survives_hostile_bytes():
    nested = b""
    for _ in range(3000):
        nested = media.box(b"moov", nested)
    file = media.mux(media.padded(b"x" * 3000))
    at = file.index(b"stsz") + 8
    huge = file[:at] + (1).to_bytes(4, "big") + (0xFFFFFFFF).to_bytes(4, "big") + file[at + 8 :]
    rnd = random.Random(1)
    broken = [bytes(b if rnd.random() > 0.01 else rnd.randrange(256) for b in file) for _ in range(300)]
    for data in (nested, huge, file[:-1], b"\0" * 100, b"\0\0\0\1moov", None, *broken):
        f = media.features(data)
        assert (f["tracks"] is None) == (f["problem"] is not None)


def test_media_column(docs, none, spark):
    got = media.media_digests(media.stored_media(docs)).collect()
    want = sorted((len(t), len(p := media.padded(t)), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), hashlib.sha256(media.mux(p)).hexdigest()) for t in ((r[1] or "").encode() for r in ROWS))
    assert sorted((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_sha256) for r in got) == want
    assert media.media_features(media.stored_media(none)).count() == 0
    wrong = spark.createDataFrame([(1, 3, bytearray(b"abc")), (2, None, None)], "doc_id long, n_bytes long, media binary")
    assert all(r.payload_sha256 is None and "Error" in r.feature for r in media.media_digests(wrong).collect())
    assert all(r.tracks is None and r.problem for r in media.media_features(wrong).collect())


def test_lm_base_and_fold(docs, none):
    path = vocabulary_path("byte_bpe_50k.tiktoken")
    got = lm_scoring.scores(docs, path).collect()
    held = lambda k: zlib.crc32(("" if k is None else str(k)).encode()) % 7 == 2
    words = lambda t: (t or "").encode().lower().split() + [b" "]
    counts = Counter(w for k, t, *_ in ROWS if not held(k) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((len(words(t)), sum(counts[w] > 0 for w in words(t)), round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 4)) for _, t, *_ in ROWS)
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    assert lm_scoring.scores(none, path).count() == 0


def test_attention_is_causal_and_its_gradient_right():
    rnd = np.random.default_rng(0)
    n = 64
    p = {k: (x + rnd.normal(0, 0.2, x.shape)).astype(np.float64) for k, x in attention_lm.fresh(n).items()}
    first, second = attention_lm.bigrams(rnd.integers(0, 9, (n, n)).astype(float))
    row = rnd.integers(0, n, 40)
    scores = lambda r: attention_lm.class_scores(p, first, second, [r[:-1]], [r[1:]])
    other = row.copy()
    other[30:] = (other[30:] + 1) % n
    assert len(scores(row)) == 39 and np.allclose(scores(row)[:29], scores(other)[:29], atol=1e-5)
    context, target = rnd.integers(0, n, (5, attention_lm.WINDOW)), rnd.integers(0, n, (5, attention_lm.STEP))
    g, _ = attention_lm.gradients(p, first, second, context, target)
    for name in p:
        at = tuple(int(x) for x in np.unravel_index(np.argmax(np.abs(g[name])), g[name].shape))
        loss = []
        for step in (1e-4, -1e-4):
            q = {k: x.copy() for k, x in p.items()}
            q[name][at] += step
            loss.append(attention_lm.gradients(q, first, second, context, target)[1])
        assert abs((loss[0] - loss[1]) / 2e-4 - g[name][at]) < 1e-3 * max(1, abs(g[name][at]))


def test_model_beats_the_base_on_held_out_text(spark):
    rnd = random.Random(4)
    vocabulary = [a + b + "ter" for a in ("ban", "cor", "dil", "fam", "gus") for b in "aeiou"]

    def text():
        at, out = rnd.randrange(25), []
        for _ in range(60):
            at = (at * 7 + 3) % 25 if rnd.random() < 0.9 else rnd.randrange(25)
            out.append(vocabulary[at])
        return " ".join(out)

    df = spark.createDataFrame([(i, text()) for i in range(400)], "doc_id long, text string")
    r = lm_scoring.scores(df, vocabulary_path("byte_bpe_50k.tiktoken")).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_quality(docs, none, spark):
    rnd = random.Random(5)
    text = lambda: " ".join(rnd.choice("alpha beta gamma delta omega kappa".split()) for _ in range(40))
    rows = [(i, text() + (" vile horrid" if i % 3 == 0 else " x%%% y%%% z%%%" if i % 3 == 1 else ""), 0 if i % 3 == 1 else 1, int(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    got = {r.doc_id: r for r in quality.document_grades(spark, df.select("doc_id", "text"), df.select("doc_id", "quality", "toxic")).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(got[i].accepted == (i % 3 == 2) for i in held) >= 0.95 * len(held)
    means = [np.mean([got[i].expected_grade for i in held if i % 3 == k]) for k in (0, 1, 2)]
    assert means[0] < means[1] < means[2]
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.document_grades(spark, docs, labels).filter("accepted").count() == len(ROWS)
    assert quality.rate(none, quality.OrdinalModel()).count() == 0


def test_pipeline_stages_take_edge_cases(spark, tmp_path, none):
    import corpus_pipeline as cp

    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "secrets", "mix", "pack"]
    for _, stage in cp.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        after.collect()
        assert stage(spark, docs.filter("FALSE"), str(tmp_path)).count() == 0
    assert cp.run(spark, str(tmp_path)).count() > 0


def test_every_training_window_gives_gradients(spark):
    path = vocabulary_path("byte_bpe_50k.tiktoken")
    rnd = random.Random(6)
    df = spark.createDataFrame([(i, " ".join(rnd.choice("ban cor dil fam gus".split()) for _ in range(rnd.randint(0, 90)))) for i in range(60)], "doc_id long, text string")
    table = lm_scoring.encoded(df, path)
    lengths = [len(r.ids) // 2 + 1 for r in table.filter("NOT held_out").collect()]
    model = lm_scoring.fit(table, len(lm_scoring._ranks(path)))  # with the parameters of the registered query
    assert model.windows == 2 * [sum(-(-n // attention_lm.STEP) for n in lengths)]


def test_each_distinct_word_is_encoded_once(monkeypatch):
    path = vocabulary_path("byte_bpe_50k.tiktoken")
    rnd = random.Random(8)
    whole = lambda t: lm_scoring._ids(b" " + b" ".join(w), path).tobytes() if (w := lm_scoring.words(t)) else b""
    odd = "abS's1. \t\n,-\xa0\u3000\u2028\x85\x1c\u200b\ufeffé\u0301日😀<|>İ²"
    texts = [" ".join(rnd.choice(("unforeseen", "It's", "a\xa0", "\xa0b", "x1,", "日本")) for _ in range(rnd.randint(0, 50))) for _ in range(40)]
    texts += ["".join(rnd.choice(odd) for _ in range(rnd.randint(0, 60))) for _ in range(400)]
    want = [whole(t) for t in texts]
    assert lm_scoring.packed(texts, path) == want
    assert lm_scoring.packed(["", " \n"], path) == [b"", b""] and lm_scoring.packed([], path) == []
    given, encode = [], lm_scoring._ids
    monkeypatch.setattr(lm_scoring, "_ids", lambda line, path: given.append(len(line)) or encode(line, path))
    docs = ["unforeseen words\tRepeat " * 500] * 20
    assert [len(x) for x in lm_scoring.packed(docs, path)] == 20 * [len(whole(docs[0]))]
    assert given[0] == len(" unforeseen words repeat")


def test_word_counts_and_frequent_words_are_exact(spark):
    path = vocabulary_path("byte_bpe_50k.tiktoken")
    rnd = random.Random(9)
    df = spark.createDataFrame([(i, " ".join(f"w{int(rnd.paretovariate(0.4)) % 700}" for _ in range(80))) for i in range(120)], "doc_id long, text string").repartition(3)
    table = lm_scoring.encoded(df, path)
    own = [(r.doc_id, lm_scoring.words(r.text), zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in df.collect()]
    want = Counter(w for _, line, held in own if not held for w in [*line, b" "])
    assert {bytes(r.word): r.c for r in lm_scoring.word_counts(table, path).collect()} == want
    divisor = sum(want.values()) + len(want) + 1
    base = {k: (sum(math.log10((want[w] + 1) / divisor) for w in [*line, b" "]), sum(w in want for w in [*line, b" "])) for k, line, _ in own}
    for hot in (0, 1, 20, 10_000):  # words taken from the driver's list, from the join, and both
        for r in lm_scoring.scores(df, path, rounds=1, hot_words=hot).collect():
            assert abs(r.base_score - base[r.doc_id][0]) < 1e-6 and r.n_known == base[r.doc_id][1]


def test_every_position_sees_half_a_window():
    n = 64
    assert attention_lm.WINDOW - attention_lm.STEP >= attention_lm.WINDOW // 2 >= 32
    p = {k: x.astype(np.float64) for k, x in attention_lm.fresh(n).items()}
    p["o"] += 0.5 * np.random.default_rng(1).normal(size=p["o"].shape)
    first, second = attention_lm.bigrams(np.ones((n, n)))
    row = np.random.default_rng(2).integers(0, n, 200)
    scores = lambda r: attention_lm.class_scores(p, first, second, [r[:-1]], [r[1:]])
    base = scores(row)
    for at in range(32, 190):
        far = row.copy()
        far[at - 31] = (far[at - 31] + 1) % n  # the earliest of the 32 inputs that end at ``at``
        assert scores(far)[at] != base[at]


def test_near_copies_equal_brute_force(spark):
    from corpus_pipeline import deduplicate
    from voxstrata.llm import near_copies

    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(5000)}"
    texts = []
    for _ in range(25):
        base = [word() for _ in range(200)]
        texts.append(base)
        for edits in (1, 2, 3, 4, 5, 6):  # similarities from 0.95 down to about 0.7
            copy = base.copy()
            for at in rnd.sample(range(200), edits):
                copy[at] = word()
            texts.append(copy)
    texts = [" ".join(t) for t in texts]
    sets = [set(near_copies.shingles(t).tolist()) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for size in (8 << 20, 4800):
        got = {r.doc_id: r.component_id for r in near_copies.near_copies(df, tile_bytes=size).collect()}
        assert [got[i] for i in range(len(texts))] == root
    assert sorted(r.doc_id for r in deduplicate(spark, df, "").collect()) == sorted(set(root))


def test_one_row_of_each_group_stays(spark):
    from voxstrata.llm import near_copies

    text = " ".join(f"w{i}" for i in range(60))
    other = "a text that nothing else is like at all"
    rows = [(1, text, 5), (1, text, 6), (1, other, 7), (2, text, 8), (None, text, 9), (None, "an unnamed text of its own", 1), (None, "an unnamed text of its own", 2), (3, None, 1), (4, "", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int").repartition(3)
    got = near_copies.first_copies(df)
    assert got.columns == df.columns
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got.collect())
    assert got == [(False, 1, other), (False, 1, text), (False, 3, ""), (True, 0, "an unnamed text of its own")]
    assert near_copies.first_copies(df.filter("FALSE")).count() == 0


def test_mix_stage_takes_what_the_plan_says(spark):
    from corpus_pipeline import mix

    rnd = random.Random(3)
    rows = [(i // 3 if i % 7 else None, " ".join("x" * rnd.randint(0, 30)) if i % 5 else "the same text", "abc"[i % 3], i, 9, 9, 9) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, times int, key int, mark int, doc int")
    got = mix(spark, df, "")
    assert got.columns == df.columns
    got = got.collect()
    want = Counter()
    for r in mixing.mixed(df, weights=(5, 2, 1), share=1.5, epochs=2).collect():
        want[r.doc_id, r.mark] += r["times"]
    have = Counter((r.doc_id, zlib.crc32(r.text.encode())) for r in got)
    assert have == +want and {(r.key, r.mark, r.doc) for r in got} == {(9, 9, 9)}
    given = Counter((r[0], r[1], r[3]) for r in rows)
    assert all(n <= 2 * given[k] for k, n in Counter((r.doc_id, r.text, r["times"]) for r in got).items())


def test_blocks_grow_with_the_fingerprints():
    assert [simhash.blocks_kept(n, 4) for n in (0, 10**6, 10**7, 10**9, 10**11)] == [1, 1, 2, 2, 3]


@pytest.mark.parametrize("words", [1, 3])
def test_tiles_link_wide_fingerprints(words):
    rnd = np.random.default_rng(8)
    base = rnd.integers(0, 1 << 64, (12, words), np.uint64)
    flips = (rnd.random((12, 60, words * 64)) < rnd.choice([0.02, 0.1, 0.3], (12, 60, 1))).astype(np.uint8)
    fps = (base[:, None] ^ np.packbits(flips, axis=2, bitorder="little").view(np.uint64)).reshape(-1, words)
    radius = 8 * words
    apart = np.bitwise_count(fps[:, None] ^ fps[None]).sum(2)
    root = np.arange(len(fps))
    while (new := np.where(apart <= radius, root, len(root)).min(1)).tolist() != root.tolist():
        root = new
    got = simhash.tiled_forest(fps if words > 1 else fps[:, 0], radius)
    assert len(set(zip(got.tolist(), root.tolist(), strict=True))) == len(set(got.tolist())) == len(set(root.tolist()))


@pytest.mark.parametrize("tile_rows", [2048, 40, 3])
def test_near_copies_meet_by_their_fingerprints(spark, tile_rows):
    """The stage's candidates come from SimHash tiles: one group, groups by blocks, and groups dealt by salts."""
    from voxstrata.llm import near_copies

    rnd = random.Random(9)
    texts, pairs = [], []
    for i in range(60):
        words = [f"w{rnd.randrange(9000)}" for _ in range(rnd.randint(5, 300))]
        other = words.copy()
        other[rnd.randrange(len(other))] += "x"
        texts += [" ".join(words), " ".join(other)]
    texts += [" ".join(["one", "text", "of", "many", "copies", "with", "its", "own", "end"] * 9 + [f"n{i}"]) for i in range(40)]
    sets = [near_copies.shingles(t) for t in texts]
    prints = np.stack([near_copies.fingerprint(s) for s in sets])
    for s, p in zip(sets, prints, strict=True):
        mixed = (s[:, None] ^ near_copies._FLIP) * near_copies._TIMES
        mixed = (mixed ^ (mixed >> 32)) * near_copies._AGAIN
        counts = [[sum(int(x) >> b & 1 for x in column) for b in range(64)] for column in (mixed ^ (mixed >> 32)).T]
        assert p.tolist() == [sum((2 * c > len(s)) << b for b, c in enumerate(column)) for column in counts]
    keys = near_copies.keys(prints, near_copies.blocks(len(texts), tile_rows))
    rows = [(i, p.view(np.int64).tolist(), k.tolist()) for i, (p, k) in enumerate(zip(prints, keys, strict=True))]
    heads = {}
    for r in near_copies.meetings(spark.createDataFrame(rows, "row long, print array<long>, keys array<int>").repartition(3), tile_rows).collect():
        heads.setdefault(r["row"], set()).add(r["head"])
    for i in range(len(texts)):
        for j in range(i):
            if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])):
                pairs.append((i, j))
                assert heads[i] & heads[j]
    assert len(pairs) > 800
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(df, tile_rows=tile_rows).collect()}
    assert all(got[i] == got[j] for i, j in pairs) and sum(got[i] == i for i in got) >= 61


def test_near_copies_refuse_similarities_their_candidates_miss(docs):
    from voxstrata.llm import near_copies

    with pytest.raises(ValueError):
        near_copies.near_copies(docs, least=0.7)
