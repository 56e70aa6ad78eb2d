import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import op1_quality, op2_jaccard, op3_html, op4_decontaminate, op5_counts, op6_mix, op7_embeddings, op8_chunks, op9_tokens, op10_substrings
from tessera.llm.kernels import merged

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, key string, tie string"


def docs(spark, texts, source="s"):
    """Documents with columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", source, len(t or ""), "x", "y", "z") for i, t in texts], DOCS)


EDGES = [(0, None), (1, ""), (2, " \n"), (3, "one two"), (3, "one two"), (4, "one two"), (None, "null id text"), (5, "w " * 3000), (6, "ü ñ 日本 😀 " * 40), (7, "x" * 5000)]


def test_empty_tables_and_edges(spark):
    bench = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    tok = public_tokenizers.path("word_bpe_49k.json")
    for d in (docs(spark, EDGES), docs(spark, [])):
        n = d.count()
        assert op1_quality.score(d, op1_quality.train(d, labels)).count() == n
        assert op2_jaccard.groups(d).count() == n
        assert op4_decontaminate.contamination(d, bench).count() == n
        assert op6_mix.mix(d).count() == n
        assert op8_chunks.dedup(d).count() == n
        assert op9_tokens.encode_documents(d, tok).count() == n
        assert op10_substrings.repeats(d).count() == n
        assert op4_decontaminate.decontaminate(d, bench).where("text is null").count() == (1 if n else 0)
    v = spark.createDataFrame([(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0, 0.0]), (7, [2.0, 0.0]), (8, [1.0]), (8, [1.0])], "vec_id long, embedding array<float>")
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in op7_embeddings.near_duplicates(v).collect()} == {(i, 0, i, True) for i in range(1, 6)} | {(6, 1, 6, True), (7, 1, 6, False), (8, 1, 8, True)}
    assert op7_embeddings.near_duplicates(v.limit(0)).count() == 0
    p = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, None, "<p>a&amp;b")], "page_id long, url string, html string")
    assert [r.text for r in op3_html.extract(p).orderBy("page_id").collect()] == ["", "", "a&b"]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from tessera.llm import common

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Elsewhere:
        conf = Conf

        class sparkContext:
            master, _tessera_dir = "spark://host:7077", None

            class _jsc:
                @staticmethod
                def sc():
                    return type("C", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Elsewhere)


def test_repeated_labelled_rows_count_once(spark):
    """However often a labelled document is repeated, one row of it comes to the driver; the model stays the same."""
    texts = [(i, f"good words {i} here" if i % 2 else f"bad!! stuff!! {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    once, often = docs(spark, texts), docs(spark, texts * 3)
    a, b = op1_quality.train(once, labels), op1_quality.train(often, labels)
    assert (a.weights == b.weights).all() and (a.bias, a.slope, a.shift) == (b.bias, b.slope, b.shift)


def test_quality_held_out_accuracy(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    texts = [(i, " ".join(word() + ("!!" if i % 3 == 0 else "") for _ in range(40))) for i in range(300)]
    d = docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i, _ in texts], "doc_id long, quality int")
    rows = op1_quality.score(d, op1_quality.train(d, labels)).where("held_out").collect()
    assert len(rows) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in texts)
    assert all(r.predicted == (r.doc_id % 3 != 0) and 0 <= r.score <= 1 for r in rows)


def test_index_keys_lose_no_link():
    rng = np.random.default_rng(1)
    for trial in range(400):
        n = int(rng.integers(1, 300))
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        hot = rng.random(1 << op2_jaccard.COUNTERS_BITS) < rng.choice([0, 0.5, 1])
        y = np.unique(np.concatenate([rng.permutation(x)[int(rng.integers(0, n * 0.2 + 1)) :], rng.integers(0, 1 << 63, int(rng.integers(0, 5)), dtype=np.uint64)]))
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= 85 * (len(x) + len(y) - both):
            assert len(np.intersect1d(op2_jaccard.keys(x, hot, 85, 100), op2_jaccard.keys(y, hot, 85, 100)))


def test_common_counts(monkeypatch):
    rng = np.random.default_rng(3)
    for listed in (2, 12):
        monkeypatch.setattr(op2_jaccard, "LISTED", listed)
        for m in (1, 2, 9, 40):
            sets = [np.unique(rng.integers(0, 60, int(rng.integers(1, 50)))).astype(np.uint64) for _ in range(m)]
            want = np.array([[len(np.intersect1d(x, y)) for y in sets] for x in sets])
            got = op2_jaccard.common_counts(sets)
            assert (got == want)[~np.eye(m, dtype=bool)].all()


@pytest.mark.parametrize("items, clash", [(1 << 19, 0), (150, 2)])
def test_groups_by_brute_force(spark, monkeypatch, items, clash):
    """With hubs of one group, and with hubs dealt out in blocks and sets that share names at first."""
    monkeypatch.setattr(op2_jaccard, "GROUP_ITEMS", items)
    own = op2_jaccard.digest
    monkeypatch.setattr(op2_jaccard, "digest", lambda s, salt=0: (own(s, salt)[0] % 50, own(s, salt)[1]) if salt < clash else own(s, salt))
    rng = random.Random(4)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(3, 90))] for _ in range(6)]
    texts = []
    for i in range(90):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = f"v{rng.randint(0, 60)}"
        texts.append((i, " ".join(w)))

    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)}

    sets, label = [shingles(t) for _, t in texts], list(range(len(texts)))
    linked = [(a, b) for a in range(90) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for _ in range(90):
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op2_jaccard.groups(docs(spark, texts)).collect()}
    assert got == {i: (len(sets[i]), label[i]) for i in range(90)}


def test_open_pairs_make_rows_by_member(spark, monkeypatch):
    """Near copies that three bytes of a shingle cannot decide: rows grow with the members of a group, not with their pairs."""
    base = [f"w{i}" for i in range(57)]
    texts = [(i, " ".join([*base, *(f"v{i}_{j}" for j in range(3 + 2 * (i % 2)))])) for i in range(80)]
    made, own = [], op2_jaccard._solved

    def counted(near, *args):
        out = op2_jaccard.cut(own(near, *args))
        made.append((near.count(), out.count()))
        return out

    monkeypatch.setattr(op2_jaccard, "_solved", counted)
    got = {r.doc_id: r.component_id for r in op2_jaccard.groups(docs(spark, texts)).collect()}
    # 54 of 60 shingles link the even ones, 54 of 62 those with the odd ones, 54 of 64 do not link the odd ones alone
    assert got == {i: 0 for i in range(80)}
    assert len(made) == 2 and all(rows < 2 * members for members, rows in made)


def test_one_of_each_by_brute_force(spark):
    """Ids of several rows lose only the rows that are copies; the pipeline's second stage is this function."""
    import corpus_pipeline

    rng = random.Random(6)
    base = [[f"w{rng.randint(0, 300)}" for _ in range(rng.randint(8, 60))] for _ in range(8)]
    texts = []
    for _ in range(70):
        w = list(rng.choice(base))
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = f"v{rng.randint(0, 9)}"
        texts.append((rng.randint(0, 40), " ".join(w)))
    texts += [(100, "one clean text of its own that no other row has"), (100, texts[0][1]), (101, "a"), (101, "b"), (102, ""), (102, None), (None, texts[0][1])]

    def shingles(t):
        w = (t or "").split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets, label = [shingles(t) for _, t in texts], list(range(len(texts)))
    linked = [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in linked:
            label[a] = label[b] = min(label[a], label[b])
    groups, want = collections.defaultdict(list), []
    for (i, t), s, g in zip(texts, sets, label):
        if i is None or not s:
            want.append((i, t))
        else:
            groups[g].append((i, t))
    want += [min(g) for g in groups.values()]
    got = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs(spark, texts), "").collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_main_text():
    p = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore. " * 2
    page = f"<html><head><title>t</title><style>x</style></head><body><nav><a href=/>home</a></nav><div class='content'><h2>Head</h2><p>{p}<p>{p}<br>end &lt;</div><div class=sidebar><p>{p}</div><section id=comments><p>{p}</section><footer>f</footer></body>"
    assert op3_html.main_text(page) == f"Head\n{p.strip()}\n{p.strip()} end <"


def test_main_text_is_elected_by_density():
    p = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore. " * 2
    body, said = f"<h2>Head</h2><p>{p}</p><p>{p}</p><p>{p}</p>", "\n".join(["Head"] + [p.strip()] * 3)
    cards = "".join(f"<article><a href=/{i}>Teaser {i}</a> More</article>" for i in range(4))
    assert op3_html.main_text(f"<body><div class=content>{body}</div><div>{cards}</div></body>") == said
    assert op3_html.main_text(f"<body><div>{cards}</div><article>{body}</article></body>") == said
    for name in ("has-sidebar", "no-header", "page has-comments"):
        assert op3_html.main_text(f"<body><div class='{name}'><div>{body}</div><div class=sidebar><p>{p}</p></div></div></body>") == said
    for wrap in ("div class=widget", "form"):
        assert op3_html.main_text(f"<body><{wrap}><nav>menu</nav><div>{body}</div></{wrap.split()[0]}></body>") == said
    # one paragraph with marks inside: the heading stays
    short = f"<h1>Head</h1><p><b>{p}<br></b></p>"
    for holder in ("article", "main", "div"):
        assert op3_html.main_text(f"<body><{holder}>{short}</{holder}></body>") == f"Head\n{p.strip()}"
    parts = f"<h1>Head</h1><section><p>{p}</p><p>{p}</p></section><section><p>Short end.</p></section>"
    for holder in ("article", "main"):
        assert op3_html.main_text(f"<body><{holder}>{parts}</{holder}></body>") == f"Head\n{p.strip()}\n{p.strip()}\nShort end."


def test_windows_and_removal(spark):
    item = " ".join(f"w{i}" for i in range(12))
    bench = spark.createDataFrame([(7, item), (8, "Short one"), (9, item)], "item_id long, text string")
    texts = [(0, f"before {item.upper()} after"), (1, "a short ONE here"), (2, " ".join(item.split()[:9])), (3, "w0 " + item + " " + "clean " * 30)]
    d = docs(spark, texts)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in op4_decontaminate.contamination(d, bench).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {0: (14, 12, 2, sha("7,9")), 1: (4, 2, 1, sha("8")), 2: (9, 0, 0, sha("")), 3: (43, 12, 2, sha("7,9"))}
    left = {r.doc_id: r.text for r in op4_decontaminate.decontaminate(d, bench).collect()}
    assert left == {1: "a here", 2: texts[2][1], 3: "w0 " + "clean " * 30}


def test_rollup_is_idempotent(spark, tmp_path):
    r = op5_counts.Rollup(spark, str(tmp_path / "r"))
    ch = lambda rows: spark.createDataFrame(rows, "op string, source string, lang string, tokenizer string, tokens long, old_tokens long")
    assert r.commit("a", ch([("insert", "s", "en", "t", 10, None), ("insert", None, "en", "t", 5, None)]))
    assert r.commit("b", ch([("revise", "s", "en", "t", 12, 10), ("delete", None, "en", "t", 5, None)]))
    assert not r.commit("b", ch([("revise", "s", "en", "t", 99, 0)]))
    want = [("s", "en", "t", 1, 12)]
    assert [tuple(x) for x in r.totals().collect()] == want
    r.compact()
    assert [tuple(x) for x in r.totals().collect()] == want and not r.commit("a", ch([("insert", "s", "en", "t", 1, None)]))


def test_mix_meets_targets(spark):
    rng = random.Random(2)
    d = docs(spark, [(i, "w " * rng.randint(1, 50)) for i in range(300)], "a").union(docs(spark, [(i, "w " * rng.randint(1, 50)) for i in range(300, 400)], "b")).union(docs(spark, [(i, "w w") for i in range(400, 410)], None))
    rows = op6_mix.mix(d).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, op6_mix.mix(d.repartition(7)).collect()), key=str)
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) < 1 and all(0 <= r.taken <= 2 * r.size for r in own)
        assert own[0].target <= 2 * own[0].source_size == 2 * sum(r.size for r in own)
    assert op6_mix.mixed(d).selectExpr("sum(size(split(trim(text), ' '))) as n").first().n == sum(r.taken for r in rows)


def test_embeddings_by_brute_force(spark):
    rng = np.random.default_rng(4)
    c = rng.standard_normal((12, 64))
    c /= np.linalg.norm(c, axis=1)[:, None]
    x = np.float32([(c[i] + rng.choice([0.1, 0.3, 0.45]) * (e := rng.standard_normal(64)) / np.linalg.norm(e)) * 2 for i in range(12) for _ in range(15)])
    got = {r.vec_id: r.n_links for r in op7_embeddings.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    want = (u @ u.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.98 * want.sum()


def test_chunks_resist_shifts(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 9))) for _ in range(500)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(60)
    texts = [(i, f"{text(rng.randint(5, 60))} {passage} {text(20)}") for i in range(4)] + [(9, text(200))]
    for a, b in ((c[1], c[2]) for c in op8_chunks.chunks(pa.array([t for _, t in texts]))):
        assert (a < b).all()
    got = {r.doc_id: r.n_removed for r in op8_chunks.dedup(docs(spark, texts)).collect()}
    assert got[0] == got[9] == 0 and all(got[i] >= 150 for i in (1, 2, 3))


def test_token_store_round_trip(spark, tmp_path):
    file = public_tokenizers.path("word_bpe_49k.json")
    texts = [(5, "I'LL don't !!'ve"), (3, "İstanbul ΑΣ <|endoftext|>"), (3, "again"), (9, None), (None, "no key"), (-4, "日本語 ½ 3º")]
    store = op9_tokens.write_store(docs(spark, texts), f"file://{tmp_path}/s", file)
    own = op9_tokens.encoder(file).own
    ids = lambda t: own.encode(t or "", add_special_tokens=False).ids + [2]
    for key in (5, 3, 9, -4):
        assert sorted(i.tolist() for _, i in store.get(key)) == sorted(ids(t) for k, t in texts if k == key)
    assert store.get(4) == [] and store.get(1 << 40) == []
    rows = op9_tokens.read_store(spark, store).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, -4, 3, 3, 5, 9]
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    assert rows[4].ids_crc32 == zlib.crc32(np.array(ids(texts[0][1]), "<u4").tobytes())
    keys = np.unique(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 3000))
    seed, shifts, slots = op9_tokens.build_index(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_encoder_by_the_library(monkeypatch):
    """Random texts of plain and odd characters, in slices so small that kept words are forgotten and learnt again."""
    enc = op9_tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(enc, "WORDS_KEPT", 500)
    monkeypatch.setattr(enc, "SLICE", 3000)
    rng = random.Random(1)
    letters = "abstmdrevl'’“\"!?. \n\t12½²ÀÉßñŒž—…€_–"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", " ", "日本 it's", "<|endoftext|> a", "İ", "a" * 5000, "x y " * 3000, "'s'll're'x''s"]
    want = [enc.pack(enc.own.encode(t, add_special_tokens=False).ids) for t in texts]
    assert list(enc.encode_all(texts)) == want and enc.turn > 10
    other = op9_tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word and list(other.encode_all(texts[-8:])) == [other.pack(other.own.encode(t, add_special_tokens=False).ids) for t in texts[-8:]]


def test_read_store_probes_the_index(spark, tmp_path):
    rng = random.Random(8)
    d = docs(spark, [(rng.choice([None, rng.randint(-50, 50), rng.randint(-(1 << 62), 1 << 62)]), f"text {i}") for i in range(400)])
    store = op9_tokens.write_store(d, f"file://{tmp_path}/s", public_tokenizers.path("word_bpe_49k.json"))
    assert op9_tokens.read_store(spark, store).count() == 400
    shard = op9_tokens.Shard(max(store.shards, key=lambda s: s["n_rows"])["path"])
    keys = np.unique([k for k, _, _ in shard.rows() if k is not None])
    assert shard.probe(keys).tolist() == [shard.find(k)[0] for k in keys.tolist()] and len(keys) > 20
    file = shard.path.removeprefix("file://")
    whole = open(file, "rb").read()
    for at in (shard.shifts_at, shard.rows_at, shard.prints_at):
        size = 4 * (shard.n_buckets if at == shard.shifts_at else shard.n_keys)
        open(file, "wb").write(whole[:at] + whole[at : at + size][4:] + whole[at : at + 4] + whole[at + size :])
        with pytest.raises(Exception, match="index does not lead"):
            op9_tokens.read_store(spark, store).count()


def test_columns_by_brute_force():
    rng, length, anchor = random.Random(5), 40, 15
    for trial in range(60):
        alphabet = b"ab" if trial % 3 == 0 else b"abcdefghij klmnop"
        some = lambda n: bytes(rng.choice(alphabet) for _ in range(n))
        shared = [some(rng.randint(30, 150)) for _ in range(4)]
        texts = [b"".join(rng.choice(shared) if rng.random() < 0.6 else some(rng.randint(0, 60)) for _ in range(rng.randint(0, 5))) + b"xy" * rng.choice([0, 0, 40]) for _ in range(6)]
        offsets = np.concatenate([[0], np.cumsum(list(map(len, texts)))]).astype(np.int64)
        t, p, a, b, h, w = op10_substrings.segments(np.frombuffer(b"".join(texts), np.uint8), offsets, length, anchor)
        spans, groups = [[] for _ in texts], collections.defaultdict(dict)
        n = collections.Counter(zip(h.tolist(), w.tolist()))
        for i, k in enumerate(zip(h.tolist(), w.tolist())):
            if n[k] > 1:
                spans[t[i]].append((int(a[i]), int(b[i]) + length))
            groups[k[0]].setdefault(k[1], i)
        rows = [(g, i) for g, (_, d) in enumerate(sorted(groups.items())) for i in d.values()]
        found = op10_substrings.repeated(np.array([g for g, _ in rows]), [texts[t[i]][a[i] : b[i] + length] for _, i in rows], np.array([a[i] - p[i] + length - anchor for _, i in rows]), length) if rows else []
        for (_, i), own in zip(rows, found):
            spans[t[i]] += [(int(a[i]) + x, int(a[i]) + y) for x, y in own]
        count = collections.Counter(x[s : s + length] for x in texts for s in range(len(x) - length + 1))
        assert [merged(s) for s in spans] == [merged([(s, s + length) for s in range(len(x) - length + 1) if count[x[s : s + length]] > 1]) for x in texts]


def test_repeats_by_brute_force(spark, monkeypatch):
    """With groups so small that whole segments, the order of an anchor's segments and that of slices all decide spans."""
    monkeypatch.setattr(op10_substrings, "GROUP", 3)
    ran, ordered = [], op10_substrings._ordered
    monkeypatch.setattr(op10_substrings, "_ordered", lambda found: ran.append(ordered(found)) or ran[-1])
    rng, length = random.Random(9), op10_substrings.LENGTH
    some = lambda n: "".join(rng.choice("abcdefgh ijé") for _ in range(n))
    often, pair, whole = some(520), some(480), some(900)
    texts = [some(150) + often + some(rng.randint(0, 200)) for _ in range(8)] + [some(90) + pair + some(300), pair + some(20), whole, whole, some(700), some(30), "", None]
    texts = list(enumerate(texts))
    raw = [(t or "").encode() for _, t in texts]
    count = collections.Counter(x[s : s + length] for x in raw for s in range(len(x) - length + 1))
    gone = [merged([(s, s + length) for s in range(len(x) - length + 1) if count[x[s : s + length]] > 1]) for x in raw]
    got = {r.doc_id: (r.n_removed, r.n_spans, bytes(r.kept)) for r in op10_substrings.repeats(docs(spark, texts), kept=True).collect()}
    kept = [b"".join(x[a:b] for a, b in zip([0] + [e for _, e in g], [s for s, _ in g] + [len(x)])) for x, g in zip(raw, gone)]
    assert got == {i: (len(x) - len(k), len(g), k) for i, (x, k, g) in enumerate(zip(raw, kept, gone))}
    assert sum(map(len, gone)) == 12 and len(ran) == 2 and all(d.count() for d in ran)


def test_sketches_lose_no_link():
    """Members that link another of their group are kept, whatever the sizes; unlike sets are mostly left."""
    rng = np.random.default_rng(5)
    for trial in range(60):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 700)), dtype=np.uint64) * np.uint64(2)
        sets = []
        for _ in range(12):
            some = base[rng.random(len(base)) < rng.choice([0.8, 0.93, 1])]
            sets.append(np.unique(np.concatenate([some, rng.integers(0, 1 << 63, int(rng.integers(0, 1 + len(base) // 8)), dtype=np.uint64), base[:1]])))
        if trial % 3 == 0:  # many items in one range
            sets = [s >> np.uint64(40) for s in sets]
        n = np.array(list(map(len, sets)))
        kept = op2_jaccard.with_partner(n, [op2_jaccard.ranges_of(s) for s in sets], 85, 100)
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                both = len(np.intersect1d(x, y))
                if i != j and 100 * both >= 85 * (len(x) + len(y) - both):
                    assert kept[i] and kept[j]
    apart = [np.sort(rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)) for _ in range(30)]
    assert op2_jaccard.with_partner(np.full(30, 400), [op2_jaccard.ranges_of(s) for s in apart], 85, 100).sum() <= 2


def test_main_text_of_made_pages():
    """Pages made around known articles: every shape of wrapping, furniture, broken markup and odd attributes."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    said = lambda n: " ".join(word() for _ in range(n)) + "."
    furniture = [
        "<nav><ul><li><a href='/a'>home</a><li><a href='/b'>more</a></ul></nav>", "<header><a href=/>Site</a> slogan</header>", "<footer><p>imprint and more</p></footer>",
        "<div class='sidebar'><p>%s</p></div>" % said(20), "<aside>%s</aside>" % said(9), "<div id=cookies>we use cookies</div>", "<div class='ad'>%s</div>" % said(8),
        "<form action='?a=1'><input value='x>y'><textarea><p>type</p></textarea></form>", "<script>var a = '<p>no</p>';</script>", "<style>p{}</style><!-- <p>no</p> -->", "<section class=comments><p>%s</p></section>" % said(30),
    ]
    wraps = ["<article>%s</article>", "<main>%s</main>", "<div class='content'>%s</div>", "<div class='has-sidebar no-header'>%s</div>", "<div class='post tags-legal'>%s</div>", "<div id='search-results'><div class='legal'>%s</div></div>", "<form>%s</form>", "<table><tr><td>%s</td></tr></table>", "<section title=it's data-x='a>b'>%s</section>"]
    starts = ["<p>", "<p title=it's>", "<p class='a b' data-q='\"'>", "<P\nID=x >"]
    for trial in range(60):
        blocks = [said(rng.randint(12, 60)) for _ in range(rng.randint(2, 6))]
        body = "<h1>%s</h1>" % (head := said(5)) + "".join(rng.choice(starts) + b.replace(" ", " &#32;\n ", 1).replace("a", "&#97;", 1) + rng.choice(["</p>", "", "</i></p>", "<br></p>"]) for b in blocks)
        before, after = (rng.sample(furniture, rng.randint(0, 5)) for _ in "ab")
        page = "<!DOCTYPE html><html lang=en><head><title>t</title></head><body>" + "".join(before) + wraps[trial % len(wraps)] % body + "".join(after) + rng.choice(["</body></html>", "", "</div></b></body>"])
        assert op3_html.main_text(page) == "\n".join([head, *blocks]), page


def test_pages_take_time_in_proportion():
    import time

    for bad in ("</i>", "</div>", "<b>", "<li>x", "<p><b>", "<td></div>", "<a href='x", '<a b="', "< ", "<div>", "<p title=it's>", "<hr>"):
        began = time.process_time()
        op3_html.main_text("<p>text</p>" + bad * 20_000)
        assert time.process_time() - began < 8, bad
    assert op3_html.main_text("<div>" * 5000 + "deep text" + "</div>" * 5000) == "deep text"


def test_commits_are_exclusive(spark, tmp_path, monkeypatch):
    """Two drivers that both saw no commit of a batch: one applies it, the other changes nothing."""
    a, b = (op5_counts.Rollup(spark, f"file://{tmp_path}/r") for _ in "ab")
    ch = lambda n: spark.createDataFrame([("insert", "s", "en", "t", 10, n)], "op string, source string, lang string, tokenizer string, tokens long, n long")
    monkeypatch.setattr(op5_counts.Rollup, "committed", lambda self: set())
    exists = lambda: sorted(p.name for p in (tmp_path / "r" / "deltas").iterdir())
    assert a.commit("one", ch(3)) and not b.commit("one", ch(3)) and len(exists()) == 1
    monkeypatch.undo()
    assert [tuple(x) for x in b.totals().collect()] == [("s", "en", "t", 3, 30)]
    a.compact()
    b.compact()
    assert [tuple(x) for x in a.totals().collect()] == [("s", "en", "t", 3, 30)] and not a.commit("one", ch(3)) and len(exists()) == 1
    with pytest.raises(Exception, match="unknown op"):
        a.commit("two", ch(1).replace("insert", "other", "op"))
    assert [tuple(x) for x in b.totals().collect()] == [("s", "en", "t", 3, 30)]


def test_counts_of_documents(spark, tmp_path):
    """Copies, nulls, empty and long texts and an empty table, with the regular tokenizers and a file's."""
    d = docs(spark, [*EDGES, (8, "one two"), (9, None), (1, "")])
    file = public_tokenizers.path("word_bpe_49k.json")
    kinds = {"words-1": op5_counts.words, "file-1": op5_counts.file_tokenizer(file)}
    got = {r.tokenizer: (r.docs, r.tokens) for r in op5_counts.count_documents(d, op5_counts.Rollup(spark, f"file://{tmp_path}/a"), tokenizers=kinds).collect()}
    texts = {t or "" for _, t in EDGES}
    own = op9_tokens.encoder(file).own
    assert got == {"words-1": (len(texts), sum(len(t.split()) for t in texts)), "file-1": (len(texts), sum(len(own.encode(t, add_special_tokens=False).ids) for t in texts))}
    assert op5_counts.count_documents(docs(spark, []), op5_counts.Rollup(spark, f"file://{tmp_path}/b"), tokenizers=kinds).count() == 0


def test_mix_splits_crowded_ranges(spark, monkeypatch):
    """However the weights gather the keys, ranges are split until few rows are ordered; the mix stays the same."""
    from pyspark.sql import functions as F

    d = docs(spark, [(i, "w " * (1 + i % 7)) for i in range(400)], "a").union(docs(spark, [(i, "w w w") for i in range(400, 440)], "b"))
    for weight in (None, F.lit(1e-6), F.lit(1e6)):
        rows = sorted(map(tuple, op6_mix.mix(d, weight=weight).collect()))
        monkeypatch.setattr(op6_mix, "EDGE_ROWS", 2)
        assert sorted(map(tuple, op6_mix.mix(d, weight=weight).collect())) == rows
        monkeypatch.undo()


def test_mixed_edges(spark):
    """Rows equal in id and text but of two sources, repeated rows, nulls, empty texts and an empty table."""
    texts = [(i, "w " * (1 + i % 9)) for i in range(60)]
    d = docs(spark, texts, "a").union(docs(spark, texts[:20], "b")).union(docs(spark, texts[:5] * 2, "b")).union(docs(spark, [(None, "null id"), (77, None), (78, "")], None))
    taken = {(r.source, r.doc_id): 0 for r in d.collect()}
    for r in op6_mix.mix(d).collect():
        taken[r.source, r.doc_id] += r.taken
    found = dict.fromkeys(taken, 0)
    for r in op6_mix.mixed(d).collect():
        found[r.source, r.doc_id] += len(r.text.split())
    assert found == taken
    assert op6_mix.mixed(docs(spark, [])).count() == 0


def test_items_without_an_id(spark):
    bench = spark.createDataFrame([(None, "null id here"), (4, "null id here")], "item_id long, text string")
    r = op4_decontaminate.contamination(docs(spark, [(1, "a null id here")]), bench).first()
    assert (r.n_hit, r.n_items, r.items_sha256) == (3, 1, hashlib.sha256(b"4").hexdigest())


def test_quality_parts_by_definition():
    """Features of a text stand for themselves, ratios are counts, and the fitted weights meet the dual's conditions."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["Ab", "c!", "12", "é", "ab"]) for _ in range(rng.randint(0, 30))) for _ in range(40)] + ["", None, "one", "long " * 4000]
    together = [f[a:b].tolist() for _, f, at in op1_quality.features(pa.array(texts)) for a, b in zip(at[:-1], at[1:])]
    alone = [f[at[0] : at[1]].tolist() for t in texts for _, f, at in op1_quality.features(pa.array([t], pa.string()))]
    assert together == alone and together[-3] == [] and len(together[-2]) == 2
    rows = [np.array(r, np.int64) for r in together]
    y = np.array([i % 3 > 0 for i in range(len(rows))], np.int64)
    ratios = op1_quality.log_count_ratios(rows, y)
    counts = [collections.Counter(v for r, k in zip(rows, y) if k == label for v in r.tolist()) for label in (1, 0)]
    totals = [sum(c.values()) + op1_quality.DIMENSIONS for c in counts]
    for v in {v for r in together for v in r}:
        assert ratios[v] == pytest.approx(np.log((counts[0][v] + 1) / totals[0]) - np.log((counts[1][v] + 1) / totals[1]))
    w, b = op1_quality.dual_descent(rows, y, ratios, rounds=300)
    values = np.zeros((len(rows), op1_quality.DIMENSIONS))
    for i, r in enumerate(rows):
        values[i, r] = ratios[r] / np.sqrt(max(len(r), 1))
    sign = np.where(y == 1, 1.0, -1.0)
    hinge = lambda w, b: 0.5 * (w @ w + b * b) + np.maximum(0, 1 - sign * (values @ w + b)).sum()
    best = hinge(w, b)
    for _ in range(30):
        step = np.random.default_rng(_).standard_normal(op1_quality.DIMENSIONS) * 0.01
        assert hinge(w + step, b) > best - 1e-6 and hinge(w, b + 0.01) > best - 1e-6 and hinge(w, b - 0.01) > best - 1e-6


def test_chunks_by_brute_force(spark):
    """Every row against a plain walk over its chunks; repeated rows, ties, nulls and long texts among them."""
    rng = random.Random(7)
    some = lambda n: " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 8))) for _ in range(n))
    shared = [some(60) for _ in range(3)]
    texts = [(rng.randint(0, 12), " ".join([some(rng.randint(0, 30)), rng.choice(shared), some(5), rng.choice(shared)])) for _ in range(20)]
    texts += [(13, None), (14, ""), (None, shared[0]), (15, shared[1] * 2), (15, shared[1] * 2), (16, some(4000))]
    split = lambda t: [(a, b, t.encode()[a:b]) for _, s, e, _ in op8_chunks.chunks(pa.array([t])) for a, b in zip(s.tolist(), e.tolist())] if t else []
    order = lambda i: -1 if i is None else i
    want = []
    for i, t in texts:
        before = {c for j, u in texts if order(j) < order(i) for _, _, c in split(u)}
        runs, own = [], set()
        for a, b, c in split(t):
            if c in before or c in own:
                runs = [*runs[:-1], (runs[-1][0], b)] if runs and runs[-1][1] == a else [*runs, (a, b)]
            own.add(c)
        raw, gone = (t or "").encode(), 0
        for a, b in runs:
            gone += b - a if b - a >= min(op8_chunks.RUN, len(raw)) else 0
        want.append((i, len(raw), gone))
    got = [(r.doc_id, r.n_bytes, r.n_removed) for r in op8_chunks.dedup(docs(spark, texts)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    """Each stage on its predecessor's rows against a plain account of what it should keep."""
    import re

    import corpus_pipeline

    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [text(14), text(25)]
    texts = [text(rng.randint(20, 60)) for _ in range(60)]
    texts = [t if i % 5 else t.replace(" ", "!! ") for i, t in enumerate(texts)]
    texts[7], texts[8], texts[9] = texts[6], f"{texts[8]} {items[0].upper()} {text(30)}", items[1]
    rows = [(i, t, "en", "ab"[i % 2], len(t or "")) for i, t in enumerate([*texts, None, "", "long text " * 2000])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(bool(i % 5)), 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before, out = found.collect(), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        found = spark.read.parquet(f"{tmp_path}/{k}")
        out[k] = found.collect()
        if k < 4:
            assert found.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    model = op1_quality.train(spark.createDataFrame(rows, schema), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = model.scores(pa.array([r.text for r in before], pa.string()))
    assert sorted(map(tuple, out[0])) == sorted(tuple(r) for r, s in zip(before, scores) if s >= 0.7)
    assert {i for i in range(60) if i % 5} - {9} <= {r.doc_id for r in out[0]} and not {i for i in range(0, 60, 5)} & {r.doc_id for r in out[0]}

    def shingles(t):
        w = (t or "").split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}

    sets = {r.doc_id: shingles(r.text) for r in out[0]}
    gone = {a for a in sets for b in sets if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert sorted(map(tuple, out[1])) == sorted(tuple(r) for r in out[0] if r.doc_id not in gone) and 7 in gone

    windows = {tuple(w[i : i + 10]) for w in (re.findall("[a-z0-9]+", t.lower()) for t in items) for i in range(len(w) - 9)}
    for r in out[1]:
        w = re.findall("[a-z0-9]+", (r.text or "").lower())
        hit = {j for i in range(len(w) - 9) if tuple(w[i : i + 10]) in windows for j in range(i, i + 10)}
        kept = [x.text for x in out[2] if x.doc_id == r.doc_id]
        assert kept == ([] if hit and 2 * len(hit) > len(w) else [r.text] if not hit else kept)
        if hit and kept:
            assert re.findall("[a-z0-9]+", kept[0].lower()) == [x for j, x in enumerate(w) if j not in hit]

    taken = {r.doc_id: r.taken for r in op6_mix.mix(spark.read.parquet(f"{tmp_path}/2")).collect()}
    mixed = collections.Counter()
    for r in out[3]:
        mixed[r.doc_id] += len(r.text.split())
    assert mixed == collections.Counter({k: v for k, v in taken.items() if v})

    own = op9_tokens.encoder(public_tokenizers.path(corpus_pipeline.TOKENIZER)).own
    ids = [(r.doc_id, own.encode(r.text, add_special_tokens=False).ids + [2]) for r in out[3]]
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in out[4]) == sorted((k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in ids)
    starts = sorted(out[4], key=lambda r: r.start)
    assert [r.start for r in starts] == np.cumsum([0] + [r.n_tokens for r in starts])[:-1].tolist() and [r.doc_id for r in starts] == sorted(r.doc_id for r in starts)


def test_several_automata_find_what_one_finds(spark, monkeypatch):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(40)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, some(rng.randint(1, 30))) for i in range(12)]
    d = docs(spark, [(i, f"{some(rng.randint(0, 40))} {rng.choice(items)[1]} {some(5)}") for i in range(40)] + EDGES)
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(str, op4_decontaminate.contamination(d, bench).collect()))
    own = op4_decontaminate.blocks
    monkeypatch.setattr(op4_decontaminate, "blocks", lambda *a: own(*a, most=20))
    assert sorted(map(str, op4_decontaminate.contamination(d, bench).collect())) == one


def test_components_by_brute_force(spark, monkeypatch):
    from tessera.llm import common

    rng = random.Random(17)
    graphs = [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(99, i) for i in range(20, 40)], [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)], [(5, 5)], []]
    for limit in (50_000, 0):
        monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
        monkeypatch.setattr(common.small, "__defaults__", (limit,))
        for g in graphs:
            label = {v: v for e in g for v in e if e[0] != e[1]}
            for _ in label:
                for a, b in g:
                    if a != b:
                        label[a] = label[b] = min(label[a], label[b])
            got = common.connected_components(spark.createDataFrame(g, "a long, b long")).collect()
            assert sorted(map(tuple, got)) == sorted(label.items())
