"""Packing, SimHash, lattice scores, pages, neighbours, and spans against plain Python."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import components, cross_polytope, html_tree, lattice, packing, sentence_spans, simhash

public_tokenizers = pytest.importorskip("public_tokenizers")


# --- packing -----------------------------------------------------------------


def _pack(df, **how):
    return packing.pack(df, **how).collect()


def test_packing_is_a_round_trip(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    rows = _pack(docs, window=512)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    expected = Counter((k, tuple(tok.encode(t or "", add_special_tokens=False).ids + [2])) for k, t in texts)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 512
    copies = Counter(k for k, _ in texts)
    for (key, ids), n in expected.items():
        if copies[key] == 1:
            own = sorted(pieces[key], key=lambda r: r.start)
            assert tuple(i for r in own for i in r.ids) == ids and {r.doc_tokens for r in own} == {len(ids)}
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in expected.items())


def test_packing_pads_little(docs):
    one = docs.coalesce(1)
    rows = _pack(one, window=256, with_ids=False)
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert sum(n < 256 for n in fill.values()) <= 1
    assert Counter(rows) == Counter(_pack(one, window=256, with_ids=False))


def test_packing_chooses_the_level_of_least_squares():
    rng = np.random.default_rng(0)
    windows = packing.Windows(40, 0)
    for n in range(600):
        size = int(rng.integers(1, 40))
        before = windows.count.copy()
        costs = {}
        for level in [0] + [h for h in range(1, 40) if before[h] and h + size <= 40]:
            after = before.copy()
            if level:
                after[level] -= 1
            if level + size < 40:
                after[level + size] += 1
            costs[level] = int((after ** 2).sum())
        chosen = windows.level_for(size)
        assert costs[chosen] == min(costs.values())
        list(windows.put((n, 0, b"\0\0\0\0" * size, size)))
    assert sum(h * c for h, c in enumerate(windows.count)) == sum(len(p[2]) // 4 for ws in windows.at.values() for w in ws for p in w)


def test_packing_fills_open_windows_when_there_are_many(spark, monkeypatch):
    df = spark.createDataFrame([(i, "the " * 130) for i in range(60)], "doc_id bigint, text string").coalesce(1)
    rows = _pack(df, window=256, with_ids=False)
    assert sum(r.length for r in rows) == 60 * 131
    assert len({r.sequence_id for r in rows}) == math.ceil(60 * 131 / 256)


def test_packing_leaves_no_words_in_its_workers(spark, docs):
    """Workers outlive their tasks, so what they keep adds to the memory of an executor's later stages."""

    def kept(batches):
        import pyarrow as pa

        for _ in batches:
            found = packing._ENCODERS.get(packing.TOKENIZER)
            words = found and len(found._words) + len(found._words._cores) + len(found._words._ends)
            yield pa.RecordBatch.from_arrays([pa.array([words], pa.int64())], names=["words"])

    _pack(docs)
    left = [r.words for r in spark.range(0, 64, 1, 64).mapInArrow(kept, "words bigint").collect()]
    found = [n for n in left if n is not None]
    assert found and max(found) == 0


def test_components_of_few_edges_take_few_tasks(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        found = components.components(spark.range(50).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
        assert found.rdd.getNumPartitions() <= 2
        assert {tuple(r) for r in found.collect()} == {(n, 0) for n in range(51)}
    finally:
        spark.conf.set(name, before)


def test_packing_of_no_rows(no_docs):
    assert _pack(no_docs) == []


def test_encoder_agrees_with_whole_texts():
    enc = packing.encoder(packing.TOKENIZER)
    odd = ["a<|endoftext|>b c", "K", "Kelvin K.", "ﬁ", "İstanbul,", "ΣΑΣ.", "ét", "가", "한국어,", "don't!!", "x\x1cy,",
           "a b", "", "  ", "日本語。", "ǅ", "#.", "'s", "'S.", "re'll..", "Å", "ẞ.", "ª,", "½", "abc٣.", "J̌.", "́"]
    texts = odd + [" ".join(odd), "\n".join(odd)]
    assert enc(texts) == [enc.whole(t) for t in texts]
    other = packing.encoder("byte_bpe_50k.json")
    assert other(texts) == [other.whole(t) for t in texts]


# --- SimHash -----------------------------------------------------------------


def _fingerprint(text):
    import xxhash

    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    counts = [0] * 64
    for x in s:
        h = xxhash.xxh64_intdigest(x, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(s))


def _roots(prints, bits):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


def test_fingerprints_and_components(docs, spark):
    rows = simhash.near_duplicates(docs).select("doc_id", simhash.hex_of(F.col("fp")).alias("fp"), "component_id").collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    expected = Counter((k, f"{_fingerprint(t):016x}") for k, t in texts)
    assert Counter((r.doc_id, r.fp) for r in rows) == expected
    roots = _roots({int(fp, 16) for _, fp in expected}, 2)
    least = {}
    for k, fp in expected:
        root = roots[int(fp, 16)]
        least[root] = min([x for x in (least.get(root), k) if x is not None], default=None)
    assert all(r.component_id == least[roots[int(r.fp, 16)]] for r in rows)


@pytest.mark.parametrize("bits", [1, 2])
@pytest.mark.parametrize("up_to", [1, 64])
def test_links_connect_what_bits_connect(spark, bits, up_to):
    rng = np.random.default_rng(3)
    prints = {0, -1, 1 << 62, -(1 << 63)}
    for center in rng.integers(-2**63, 2**63, size=25, dtype=np.int64).tolist():
        for _ in range(12):
            x = center
            for b in rng.choice(64, size=rng.integers(0, 4), replace=False).tolist():
                x ^= 1 << b if b < 63 else -(1 << 63)
            prints.add(x)
    df = spark.createDataFrame([(x,) for x in prints], "fp bigint")
    got = {r.node: r.root for r in components.components(simhash.links(df, bits, up_to)).collect()}
    expected = _roots(prints, bits)
    groups = defaultdict(set)
    for x, root in expected.items():
        groups[root].add(x)
    for members in groups.values():
        if len(members) > 1:
            assert {got[x] for x in members} == {min(members)}
        else:
            assert not members & got.keys()


def test_pivots_never_discard_a_link():
    rng = np.random.default_rng(4)
    x = rng.integers(-2**63, 2**63, size=500, dtype=np.int64).view(np.uint64)
    y = x ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))
    p = np.array(simhash._pivots(), dtype=np.int64).view(np.uint64)
    difference = np.abs(np.bitwise_count(x[:, None] ^ p).astype(int) - np.bitwise_count(y[:, None] ^ p).astype(int))
    assert difference.max() <= 2


def test_components_of_paths_and_none(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components.components(df.limit(0)).count() == 0


def test_dedup_keeps_one_of_a_group(docs, no_docs):
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns
    prints = {_fingerprint(r.text) for r in docs.collect()}
    assert kept.count() == len(set(_roots(prints, 2).values()))
    assert simhash.dedup(no_docs).count() == 0


# --- lattice -----------------------------------------------------------------


def test_marginals_are_sums_over_segmentations():
    pieces = lattice.Pieces(lattice.VOCABULARY)
    ids = lattice.vocabulary(lattice.VOCABULARY).ids

    def brute(word):
        word = lattice.MARK + word

        def rest(i):
            if i == len(word):
                return 1.0
            return sum(
                math.exp(pieces.log[ids[word[i:j]]]) * rest(j) for j in range(i + 1, len(word) + 1)
                if ids.get(word[i:j], -1) >= 0 and (i == 0 or i >= len(lattice.MARK)))

        return math.log(rest(0)) + pieces.stop

    words = [b"the", b"thandor,", "é".encode(), "日本x".encode(), b"a", b"\xff\xfe", b"x" * 14]
    got = lattice.marginals(words, pieces)
    assert got == pytest.approx([brute(w) for w in words])
    assert math.isfinite(lattice.marginals([b"ab" * 20000], pieces)[0])


def test_expectation_maximisation_raises_the_likelihood(spark, texts):
    words = sorted({w for _, t in texts for w in lattice.tokens(t)})[:400]
    pieces, last = lattice.Pieces(lattice.VOCABULARY), -math.inf
    for _ in range(3):
        expected = np.zeros(len(pieces.log))
        total = lattice.marginals(words, pieces, expected).sum()
        assert total > last
        last, pieces = total, lattice.Pieces(lattice.VOCABULARY, expected, len(words))
    begin = lattice.vocabulary(lattice.VOCABULARY).starts
    assert np.exp(pieces.log[begin]).sum() == pytest.approx(1)
    assert np.exp(pieces.log[~begin]).sum() + math.exp(pieces.stop) == pytest.approx(1)


@pytest.mark.parametrize("frequent, block", [(0, 500_000), (300, 1000), (1 << 18, 0)])
def test_scores(docs, monkeypatch, frequent, block):
    monkeypatch.setattr(lattice, "FREQUENT", frequent)
    monkeypatch.setattr(lattice, "BLOCK_WORDS", block)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    rows = lattice.score(docs, held).collect()
    texts = [(r.doc_id, lattice.tokens(r.text)) for r in docs.collect()]

    def out(k):
        return k is not None and zlib.crc32(str(k).encode()) % 5 == 1

    counts, ends = Counter(), 0
    for k, w in texts:
        if not out(k):
            counts.update(w)
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    assert len(rows) == len(texts)
    by_key = defaultdict(list)
    for k, w in texts:
        by_key[k].append(w)
    table = docs.sparkSession.createDataFrame([(w, c) for w, c in counts.items()], "word binary, n bigint")
    pieces = lattice.fit_pieces(table)
    every = sorted({x for _, w in texts for x in w})
    marginal = dict(zip(every, np.exp(lattice.marginals(every, pieces))))
    log_marginal = dict(zip(every, lattice.marginals(every, pieces) / math.log(10)))
    left = lattice.DISCOUNT * len(counts) / sum(counts.values())
    end = (ends + 0.5) / (n + 1)

    def text_score(w):
        total, seen = math.log10(end) + len(w) * math.log10(1 - end), Counter()
        for place, x in enumerate(w):
            corpus = max(counts[x] - lattice.DISCOUNT, 0) / sum(counts.values()) + left * marginal[x]
            mixed = (1 - lattice.ADAPT) * corpus + lattice.ADAPT * seen[x] / place if place else corpus
            if mixed > 0:
                total += math.log10(mixed)
            else:
                total += math.log10(left) + log_marginal[x] + (math.log10(1 - lattice.ADAPT) if place else 0)
            seen[x] += 1
        return total

    for r in rows:
        w = by_key[r.doc_id][0]
        base = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w) + math.log10((ends + 0.5) / (n + 0.5 * (v + 1)))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out(r.doc_id), len(w) + 1, sum(x in counts for x in w) + 1, n)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(text_score(w))
        assert r.piece_score == pytest.approx(
            math.log10(end) + len(w) * math.log10(1 - end) + sum(log_marginal[x] for x in w))


def test_scores_of_no_and_of_unseen_rows(spark, no_docs):
    assert lattice.score(no_docs, F.lit(False)).count() == 0
    df = spark.createDataFrame([(1, "never seen")], "doc_id bigint, text string")
    r = lattice.score(df, F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isfinite(r.score)


# --- pages -------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site head, with words, and more</header>
<nav><ul><li><a href=x>Menu one</a></ul></nav><div class="cookie-notice">We use cookies, yes, many.</div>{open}<h1>Head &amp; line</h1>
<p>First   paragraph, with commas, and&nbsp;words enough to count.<br>second line</p><p><b>Unclosed <i>bold<p>Next, one, with a
line break and <a href="y">a link</a>.<ul><li>item one<li>item two</ul><form><p>Enter, your, mail, address, here, please</form>
<script>var x = "</p>";</script><blockquote>Quoted, words, here.</blockquote>{close}<aside><p>Side, words, that, are, long, enough, here.</p></aside>
<section id="comments"><p>Nice, article, I, really, liked, it, thanks.</p></section><div class="sidebar"><p>See, also, these, other, pages.</p></div>
<footer>&copy; x</footer></body></html>"""
MAIN = ("Head & line\nFirst paragraph, with commas, and words enough to count. second line\nUnclosed bold\n"
        "Next, one, with a line break and a link.\nitem one\nitem two\nQuoted, words, here.")


@pytest.mark.parametrize("open_, close", [("<article>", "</article>"), ("<div class=post>", "</div>"), ("<main>", "</main>"), ("<div id=x>", "</div>")])
def test_main_text(open_, close):
    assert html_tree.extract(PAGE.replace("{open}", open_).replace("{close}", close)) == MAIN


@pytest.mark.parametrize("page, expected", [
    (None, ""), ("", ""), ("plain &lt;text&gt; only", "plain <text> only"), ("<p>a<p>b", "a\nb"), ("<div><p>x</p><scri", "x"),
    ("<article><p>one, two<p>thr", "one, two\nthr"), ("<p>a</p><!-- b", "a"), ("<nav>only menu</nav>", ""), ("a < b", "a < b"),
    ("<p title='a > b'>x</p>", "x"), ("<article><h1>H</h1></article>", "H"), ("<div hidden>x</div><p>y", "y"),
])
def test_odd_pages(page, expected):
    assert html_tree.extract(page) == expected


def test_deep_pages_end():
    assert html_tree.extract("<div>" * 20000 + "deep, text").endswith("deep, text")
    assert html_tree.extract("<b>" * 5000 + "<p>x" * 2000).count("x") == 2000


def test_pages_as_rows(spark):
    rows = [(1, "u", PAGE, 5, "old"), (1, "u", PAGE, 5, "old"), (2, None, None, 6, "old")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int, text string")
    got = html_tree.main_text(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert all(r.n_chars == len(r.text) for r in got.collect()) and got.count() == 3
    assert html_tree.main_text(df.limit(0)).count() == 0


# --- neighbours --------------------------------------------------------------


def _search(spark, vectors, **how):
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, id int, v string")
    got = defaultdict(list)
    for r in cross_polytope.search(df, df.where("vec_id % 5 = 0"), **how).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(found)] for q, found in got.items()}, df


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "ROWS_PER_CHUNK", 40)
    rng = np.random.default_rng(8)
    data = rng.normal(size=(400, 16)).astype(np.float32)
    data[100:160] = data[5]  # a hot vector
    rows = [(i, [float(x) for x in v], i, "x") for i, v in enumerate(data)]
    odd = [(1000, None, 0, ""), (1005, [], 0, ""), (1010, [0.0] * 16, 0, ""), (1015, [float("nan")] * 16, 0, ""),
           (1020, [None] * 16, 0, ""), (1025, [float("inf")] + [0.0] * 15, 0, ""), (1030, [1.0, 2.0], 0, ""), (None, [1.0] * 16, 0, "")]
    got, _ = _search(spark, rows + odd, k=20)
    data = data.astype(float)
    hit = total = 0
    for q in range(0, 400, 5):
        scores = data @ data[q]
        order = [i for i in np.lexsort((np.arange(400), -scores)) if i != q][:20]
        hit += len(set(order) & {i for i, _ in got[q]})
        total += 20
        assert len(got[q]) == 20 and all(abs(s - scores[i]) < 1e-9 for i, s in got[q])
        assert [(-s, i) for i, s in got[q]] == sorted((-s, i) for i, s in got[q])
    assert hit / total >= 0.95
    assert set(got) == set(range(0, 400, 5))


def test_neighbours_of_few_and_none(spark):
    got, df = _search(spark, [(0, [1.0, 0.0], 0, ""), (1, [2.0, 0.0], 0, ""), (2, [-1.0, 0.5], 0, "")])
    assert got == {0: [(1, 2.0), (2, -1.0)]}
    assert cross_polytope.search(df.limit(0), df.limit(0)).count() == 0


def test_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 32))
    assert np.linalg.norm(cross_polytope._hadamard(x), axis=1) == pytest.approx(np.linalg.norm(x, axis=1))
    first = cross_polytope.buckets(x, 3, 4)
    assert (first[:, 0] == cross_polytope.buckets(x, 3)[:, 0]).all()
    assert (cross_polytope.buckets(-x, 3)[:, 0] == first[:, 0] ^ 1).all()


# --- spans -------------------------------------------------------------------


def test_spans_against_brute_force(docs, texts):
    rows = {r.doc_id: r for r in sentence_spans.dedup(docs).where("doc_id is not null").collect()}

    def norm(s):
        return b" ".join(s.encode().lower().split())

    seen = defaultdict(list)
    for k, t in texts:
        parts = sentence_spans.sentences(t or "")
        assert "".join(parts) == (t or "")
        at = [i for i, s in enumerate(parts) if norm(s)]
        for b in range(len(at)):
            for e in range(b + 1, len(at) + 1):
                n = sum(len(norm(parts[i]).split()) for i in at[b:e])
                if n >= 50 or n >= 20 and e - b >= 3:
                    seen[tuple(norm(parts[i]) for i in at[b:e])].append((k, at[b], at[e - 1]))
                    break
    gone = defaultdict(set)
    for places in seen.values():
        for k, a, b in sorted(places)[1:]:
            gone[k].update(range(a, b + 1))
    assert gone
    for k, t in texts:
        parts = sentence_spans.sentences(t or "")
        kept = "".join(s for i, s in enumerate(parts) if i not in gone[k])
        assert rows[k].text == (None if t is None else kept)
        assert (rows[k].n_sentences, rows[k].n_removed) == (len(parts), len(gone[k]))
        cut = [tuple(map(int, x.split(":"))) for x in rows[k].removed.split(",") if x]
        assert "".join(t[a:b] for a, b in cut) == "".join(s for i, s in enumerate(parts) if i in gone[k])


def test_spans_pass_other_columns(docs, no_docs):
    got = sentence_spans.dedup(docs)
    assert got.columns == [*docs.columns, "n_sentences", "n_removed", "removed"]
    assert got.count() == docs.count()
    assert sentence_spans.dedup(no_docs).count() == 0
