import hashlib
import html
import os
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from graniteflow.llm import classifier, extract, fingerprints, ngram_join, packing, rules, token_counts
from graniteflow.llm.order import deal_by_order

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def key(row):
    return tuple((x is None, x) for x in row)


# ------------------------------------------------------------------ fingerprints
def simhash(text):
    words = WORD.findall(text)
    terms = [" ".join(words[i : i + 2]).encode() for i in range(len(words))]
    seed = xxhash.xxh64_intdigest((2).to_bytes(8, "little"), 42)
    votes = np.zeros(128, int)
    for t in terms:
        for half, h in enumerate((xxhash.xxh64_intdigest(t, 42), xxhash.xxh64_intdigest(t, seed))):
            votes[64 * half : 64 * half + 64] += [1 if h >> b & 1 else -1 for b in range(64)]
    value = [sum(1 << b for b in range(64) if votes[64 * half + b] > 0) for half in (0, 1)]
    return f"{value[0]:016x}{value[1]:016x}"


def near(a, b):
    return 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 128


def test_fingerprints_match_brute_force(odd_docs, odd_rows):
    rows = sorted([(r[0], r[1] or "") for r in odd_rows], key=key)
    expected = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        f, g, n = simhash(text), simhash(edited), simhash(after)
        expected.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), f, g, near(f, g), near(f, n)))
    prints = [r[3] for r in expected]
    within = [None if r[0] is None or r[0] % 50 else sum(near(r[3], p) >= 1 - 3 / 128 for p in prints) for r in expected]
    out = fingerprints.document_fingerprints(odd_docs).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_within")
    assert sorted(map(tuple, out.collect()), key=key) == sorted([(*r, w) for r, w in zip(expected, within)], key=key)
    plain = {(r.doc_id, r.fingerprint) for r in fingerprints.fingerprints(odd_docs).collect()}
    assert plain == {(r[0], r[3]) for r in expected}


def test_no_documents_no_fingerprints(no_docs):
    assert fingerprints.document_fingerprints(no_docs).count() == 0 and fingerprints.fingerprints(no_docs).count() == 0


@pytest.mark.parametrize("radius, blocks", [(0, 4), (3, 4), (5, 8)])
def test_block_tables_find_all_within_the_radius(spark, radius, blocks):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(-(2**63), 2**63, 30)]
    flip = lambda x, n: int(np.int64(x) ^ np.int64(sum(1 << int(b) for b in rng.choice(62, n, replace=False))))
    rows = [(x, y) for x, y in zip(base[:15], base[15:])]
    rows += [(flip(x, k), flip(y, j)) for x, y in rows for k in range(4) for j in range(3)] + rows[:3]
    df = spark.createDataFrame(rows, "_hi bigint, _lo bigint")
    bits = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    expected = {(a, b): sum(bits(a, c) + bits(b, d) <= radius for c, d in rows) for a, b in rows}
    got = {(r._hi, r._lo): r.n_within for r in fingerprints.within_radius(df, df, radius, blocks).collect()}
    assert got == expected


@pytest.mark.parametrize("radius, blocks", [(3, 4), (5, 6), (8, 4), (18, 8), (20, 8), (23, 8), (20, 6), (12, 4)])
def test_partners_are_all_pairs_within_the_radius(spark, radius, blocks):
    rng = np.random.default_rng(2)
    wide = lambda x: int.from_bytes(x.tobytes(), "little")
    base = [wide(rng.integers(0, 256, 16, np.uint8)) for _ in range(8)]
    values = base + [x ^ sum(1 << int(b) for b in rng.choice(128, n, replace=False)) for x in base for n in (1, 3, 9, 17, 18, 19, 20, 21, 23, 24, 30)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    halves = [(signed(x & (2**64 - 1)), signed(x >> 64)) for x in values]
    df = spark.createDataFrame(halves + halves[:2], "_hi bigint, _lo bigint")
    expected = {(p, q): ((x ^ y).bit_count(), 1 + (q in halves[:2])) for p, x in zip(halves, values) for q, y in zip(halves, values) if (x ^ y).bit_count() <= radius}
    rows = fingerprints.pairs_within(df, df, radius, blocks).collect()
    assert {((r._hi, r._lo), (r._hi2, r._lo2)): (r.distance, r._copies) for r in rows} == expected and len(rows) == len(expected)


def test_blocks_widen_as_the_fingerprints_grow():
    sizes = [10**k for k in range(3, 13)]
    chosen = [fingerprints.cheapest_blocks(n, 20) for n in sizes]
    assert chosen == sorted(chosen, reverse=True) and chosen[0] == 16 and chosen[-1] == 4
    met = {n: fingerprints.probe_counts(b, 20)[1] * n for n, b in zip(sizes, chosen)}
    assert met[10**9] < 10 ** 3 * met[10**6] / 4
    for blocks in (4, 6, 8, 16):
        reaches = fingerprints._reaches(blocks, 20)
        assert sum(r + 1 for r in reaches) == 21 and sum(fingerprints._widths(blocks)) == 128


def test_edited_copies_count_as_near(spark):
    from graniteflow.llm import queries

    rng = np.random.default_rng(3)
    words = [f"w{n}" for n in rng.integers(0, 5000, 400)]
    near = words[:200] + ["changed", "here"] + words[202:]
    other = [f"w{n}" for n in rng.integers(0, 5000, 400)]
    df = spark.createDataFrame([(50, " ".join(words)), (51, " ".join(near)), (52, " ".join(other))], "doc_id bigint, text string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "_table", lambda *a: df)
        assert {r.doc_id: r.n_within for r in queries.op1_fingerprints(spark, "").collect()} == {50: 2, 51: None, 52: None}


def test_each_row_stands_before_its_successor(spark):
    from pyspark.sql import functions as F

    keys = [5, 5, None, 1, 9, 2**60, 2**60 + 1, 7]
    rows = deal_by_order(spark.createDataFrame([(k,) for k in keys], "k bigint"), F.col("k"), [F.col("k")]).collect()
    assert sorted((r.k for r in rows if not r._guest), key=lambda k: (k is not None, k or 0)) == sorted(keys, key=lambda k: (k is not None, k or 0))
    ranges = defaultdict(list)
    for r in rows:
        ranges[r._range].append((r._guest, r._key))
    homes = sorted(min(k for g, k in v if not g) for v in ranges.values())
    for v in ranges.values():
        last, guests = max(k for g, k in v if not g), [k for g, k in v if g]
        assert guests and min(guests) == next((h for h in homes if h > last), homes[0])


# ------------------------------------------------------------------ packing
def test_pieces_are_the_tokenizers_ids(odd_docs, odd_rows):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    expected = []
    for doc, text, *_ in odd_rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, s in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[s : s + 4096], "<u4")
            expected.append((doc, k, s, len(part), zlib.crc32(part.tobytes())))
    rows = packing.pack_documents(odd_docs).collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=key) == sorted(expected, key=key)
    check_sequences(rows)


def check_sequences(rows):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096
    return len(bins)


def test_sequences_are_nearly_full(spark):
    rows = packing.pack_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    assert check_sequences(rows) <= 1.02 * sum(r.length for r in rows) / 4096 + 1


def test_no_documents_no_sequences(no_docs):
    assert packing.pack_documents(no_docs).count() == 0


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    bins = packing.BestFit(capacity=10, open_bins=2)
    assert [bins.place(n) for n in (6, 8, 2, 9, 4)] == [(0, 0), (1, 0), (1, 8), (2, 0), (0, 6)]
    bins = packing.BestFit(capacity=10, open_bins=1)
    assert [bins.place(n) for n in (5, 7, 5)] == [(0, 0), (1, 0), (2, 0)]


def test_chunk_cache_survives_being_emptied():
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    chunks = packing.ChunkIds(packing.tokenizer_path(), limit=3)
    for text in ["Été, Übung. x!!", "a b c d e", "", "a Été,", "İ ΑΣ Σ\u0301 \x1c|\x85q 5.4,", "don't 'S it's"]:
        ids, lengths = chunks.encode([text.encode(), b"", b"a."])
        expected = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in (text, "", "a.")]
        assert ids.tolist() == sum(expected, []) and lengths.tolist() == [len(e) for e in expected]


# ------------------------------------------------------------------ token counts
def test_edited_counts_match_full_counts(spark, odd_docs, odd_rows):
    from pyspark.sql import functions as F

    by = token_counts.splitter(None)
    edits = token_counts.document_edits(F.col("text"), F.col("source"), F.col("lang"))
    out = token_counts.edited_counts(odd_docs, edits).collect()
    expected = []
    for doc, text, lang, source, _ in odd_rows:
        old = text or ""
        third = len(old) // 3
        label = " ".join([source or "", lang or ""])
        new = old[:third] + label + old[third + 20 :]
        spot, again = min(2 * third, len(new)), max(0, 2 * third - 30)
        copied = "" if text is None or 2 * third - 29 < -30 else spark_substring(old, 2 * third - 29, 30)
        new = new[:spot] + copied + new[spot:]
        full = lambda t: len(by.encoding.encode_ordinary(t))
        expected.append((doc, len(old), full(old), len(new), full(new)))
    assert sorted([tuple(r)[:5] for r in out], key=key) == sorted(expected, key=key)
    long = max(out, key=lambda r: r.n_chars)
    assert 0 < long.reencoded_chars < 1000


def spark_substring(text, start, length):
    """Spark's substring: 1 is the first, 0 too, negative counts from the end."""
    begin = start - 1 if start > 0 else len(text) + start if start < 0 else 0
    return text[max(0, begin) : max(0, begin + length)]


def test_trees_stay_exact_over_many_edits():
    import random

    rng, by = random.Random(3), token_counts.splitter(None)
    parts = ["a", "the ", " ", "\n", "é", "1", "'s", "!!", "\t", "word", "  "]
    make = lambda n: "".join(rng.choice(parts) for _ in range(n))
    for size in [0, 1, 5, 50, 400, 1500] * 15:
        text = make(size)
        tree = token_counts.CountTree(text, by)
        for _ in range(6):
            a = rng.randint(0, len(text) + 2)
            b, new = a + rng.choice([0, 1, 20, len(text)]), make(rng.choice([0, 1, 10, 300]))
            tree.edit(a, b, new)
            a, b = min(a, len(text)), min(max(a, b), len(text))
            text = text[:a] + new + text[b:]
            assert tree.text() == text and tree.count == len(by.encoding.encode_ordinary(text)) and len(tree) == len(text)


def test_no_documents_no_counts(no_docs):
    from pyspark.sql import functions as F

    assert token_counts.edited_counts(no_docs, token_counts.document_edits(F.col("text"), F.col("source"), F.col("lang"))).count() == 0


# ------------------------------------------------------------------ quality rules
def base_measures(text):
    words = WORD.findall(text)
    spots = defaultdict(list)
    for i in range(len(words) - 7):
        spots[tuple(words[i : i + 8])].append(i)
    covered = {i + k for found in spots.values() if len(found) > 1 for i in found for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    longest, size = 0, 8
    while len(words) >= size and max(Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)).values()) > 1:
        longest, size = size, size + 1
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), longest


def test_quality_rules_match_brute_force(spark, odd_docs, odd_rows):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    for df, rows in ((odd_docs, [(r[0], r[1]) for r in odd_rows]), (spark.createDataFrame(docs, "doc_id bigint, text string"), docs)):
        expected = []
        for doc, text in rows:
            m = base_measures(text or "")
            failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
            expected.append((doc, *m, failed, not failed and 100 * m[5] <= 15 * m[0]))
        assert sorted(map(tuple, rules.judge(df).collect()), key=key) == sorted(expected, key=key)


def test_repeats_of_small_alphabets():
    import random

    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh"[:k]) for _ in range(rng.randint(0, 70))) for k in (1, 2, 3, 5) for _ in range(40)]
    measured = list(zip(*(m.tolist() for m in rules.measure([t.encode() for t in texts]))))
    assert measured == [base_measures(t) for t in texts]


def test_kept_rows_keep_their_columns(odd_docs, no_docs):
    kept = rules.keep_passing(odd_docs)
    assert kept.columns == odd_docs.columns and 0 < kept.count() < odd_docs.count()
    assert rules.keep_passing(no_docs).count() == 0 and rules.judge(no_docs).count() == 0


# ------------------------------------------------------------------ page text
def test_articles_of_the_given_pages(spark):
    for page in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", article)]
        assert extract.main_text(page.html) == "\n".join(b for b in blocks if b)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="page home"><header><h1>Site</h1><a href="/">Home</a></header>
<div id="cookie-notice"><p>We use cookies on this site, and we tell you so at great length in this notice of ours.</p></div>
<div class="sidebar"><ul><li><a href="/a">A first link of the side</a></li><li><a href="/b">B</a></li></ul></div>
<div class="content"><h2>Heading &amp; more</h2><p>The first paragraph of the text has a fair number of words, <b>some</b>
 of them <a href="/x">linked</a>.<p>Short.</p><ul><li>An item of the list in the middle of it all</li></ul>
<div class="ad-box"><p>Buy now, buy cheap, buy all the things that we sell here.</p></div>
<p>The last paragraph is long enough as well to stand high on the curve of the lines.&nbsp;&lt;end&gt;</p></div>
<form><p>Your name, please, and much more text that belongs to the form</p><input name="q"></form>
<section id="comments"><h3>Comments</h3><p>I liked this text a lot, and I write a long comment about it, longer than most.</p></section>
<footer>&copy; somebody</footer><script>if (a < b) document.write("<p>no</p>")</script></body></html>"""


def test_pages_without_article_element():
    assert extract.main_text(PAGE) == (
        "Heading & more\nThe first paragraph of the text has a fair number of words, some of them linked.\nShort.\n"
        "An item of the list in the middle of it all\nThe last paragraph is long enough as well to stand high on the curve of the lines. <end>"
    )


@pytest.mark.parametrize("page, text", [
    ("", ""), ("   ", ""), ("<p>", ""), ("<script>x", ""), ("plain text", "plain text"), ("<nav>only a menu</nav>", ""), ("a<!-- b", "a"),
    ("<article><p>One.</p><aside>side</aside><p>Two<br>three &#x41;&eacute;</p><div class='comments'>no</div></article><p>Much longer text after the article.</p>", "One.\nTwo\nthree Aé"),
    ("<main><header><h1>Title</h1></header><p>x</main>", "Title\nx"),
])
def test_small_pages(page, text):
    assert extract.main_text(page) == text


@pytest.mark.parametrize("sizes", [[300] * 10 + [30_000] + [300] * 10, [40, 150] + [1000] * 8 + [150, 30]])
def test_long_and_short_paragraphs_are_kept(sizes):
    lines = [("word " * n)[:n].strip() for n in sizes]
    body = "".join(f"<p>{x}</p>" for x in lines)
    page = f"<ul><li><a href='/'>Some menu entry</a></li></ul><div>{body}</div><ul><li><a href='/x'>Other entry</a></li></ul>"
    assert extract.main_text(page) == "\n".join(lines)


@pytest.mark.parametrize("page, text", [
    *[(f"<div {x}><article><h1>Title</h1><p>Some text.</p></article></div>", "Title\nSome text.") for x in ("class='content with-sidebar'", "class='layout no-sidebar'", "id=page-header-fixed", "class='page widget'", "role=search")],
    ("<article><div class='article-header'><h1>Title</h1></div><div class='header'>By me</div><p>Some text.</p></article>", "Title\nBy me\nSome text."),
    ("<article><p title='a hidden gem'>One.</p><p hidden>Two.</p><p hidden=''>Three.</p><div class='comment-list'>No.</div></article>", "One."),
    ("<div class='search'><h1>Title</h1><p>All of the text is within.</p></div>", "Title\nAll of the text is within."),
    ("<article>Text.</article><aside><article>Other.</article></aside>", "Text."),
    ("<div hidden><article>Unseen.</article></div>", ""),
])
def test_marks_are_whole_names_and_yield_to_the_article(page, text):
    assert extract.main_text(page) == text


BODY = "".join(f"<p>Paragraph {i} of the text says a number of things about its subject.</p>" for i in range(4))
BODY_TEXT = "\n".join(f"Paragraph {i} of the text says a number of things about its subject." for i in range(4))


@pytest.mark.parametrize("page, text", [
    (f"<div class='post'><h1>Head</h1>{BODY}</div><article>Nice post by Bob!</article><article>So it is.</article>", "Head\n" + BODY_TEXT),
    (f"<h1>Head</h1>{BODY}<aside><article>A teaser</article></aside>", "Head\n" + BODY_TEXT),
    (f"<h1>Head</h1>{BODY}<article class='comment'>A comment</article>", "Head\n" + BODY_TEXT),
    (f"<article>{BODY}</article><article class='comment'>Me too.</article><article class='ad-box'>Buy it.</article>", BODY_TEXT),
    (f"<article>{BODY}<article>A comment inside the article.</article></article>", BODY_TEXT),
    (f"<article><article>{BODY}</article><article>{BODY}</article></article>", BODY_TEXT + "\n" + BODY_TEXT),
    (f"<div class='cookie-banner-wrap'>We use cookies on this site, and we say so at length.</div>{BODY}", BODY_TEXT),
    (f"<article>{BODY}<div class='ad-box'>Buy now</div><p>End.</p></article>", BODY_TEXT + "\nEnd."),
    (f"<main><h1>Head</h1><article>{BODY}</article><article>A teaser.</article></main>", "Head\n" + BODY_TEXT),
    (f"<p title=\"it's>{BODY}", BODY_TEXT),
])
def test_the_curve_and_the_marks_find_the_side_with_the_text(page, text):
    assert extract.main_text(page) == text


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(0, 400), min_size=1, max_size=40).filter(any))
def test_surge_and_dive_against_every_window(sizes):
    surge, dive, least = extract.text_span(np.array(sizes))
    counting = sorted(x for x in sizes if x)
    middle = (counting[(len(counting) - 1) // 2] + counting[len(counting) // 2]) / 2
    clipped = [min(x, extract.CLIP * middle) for x in sizes]
    windows = range(1 - extract.WINDOW, len(sizes))
    total = lambda values, i: sum(values[max(0, i) : i + extract.WINDOW])
    level = extract.LEVEL * max(total(clipped, i) for i in windows)
    high = [i for i in range(len(sizes)) if total(sizes, i) > level]
    inside = [i for i in range(high[0], min(len(sizes), high[-1] + extract.WINDOW)) if sizes[i] > level / extract.WINDOW]
    assert (surge, dive) == (inside[0], inside[-1]) and least == pytest.approx(level / extract.WINDOW)


@pytest.mark.parametrize("page", [
    "<div>" * 200_000, "<div>" * 8_000 + "</b>" * 8_000, "<b>" + "<div>" * 8_000 + "</b>" * 8_000, "<div class='ad'><p>x</p>" * 40_000,
    "<article class='ad'><p>x</p>" * 30_000, "<i>" * 100_000 + "<p>" * 100_000, "<object>" * 100_000, '<a "" ' * 100_000 + '<a "', "<div " + "a" * 1_000_000 + ">",
])
def test_time_is_linear_in_the_page(page):
    began = time.process_time()
    extract.main_text(page)
    assert time.process_time() - began < 3


def test_every_page_has_a_row(spark):
    rows = [(1, "u", "<p>Hello there</p>"), (1, "u", "<p>Hello there</p>"), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, text string")
    got = sorted(map(tuple, extract.extract_pages(df).collect()), key=key)
    assert got == sorted([(1, "u", "Hello there", 11)] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=key)
    assert extract.extract_pages(df.where("false")).count() == 0


# ------------------------------------------------------------------ classifier
def test_held_out_documents_are_told_apart(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    ranker = classifier.train(docs, labels)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = classifier.classify(docs, ranker).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([t == p for t, p in judged]) > 0.95
    again = classifier.train(docs.repartition(5), labels.repartition(3))
    assert np.allclose(again.weights, ranker.weights) and np.isclose(again.threshold, ranker.threshold)


def test_classifier_with_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(7, 1), (7, 1), (13, 1), (14, 0), (None, 1), (22, None), (14, 0), (21, 1), (18, 0)], "doc_id bigint, quality int")
    ranker = classifier.train(odd_docs, labels)
    rows = classifier.classify(odd_docs, ranker).collect()
    assert len(rows) == odd_docs.count() and all(np.isfinite(r.score) for r in rows)
    assert classifier.classify(no_docs, ranker).count() == 0
    none = classifier.train(no_docs, labels.where("false"))
    assert {r.score for r in classifier.classify(odd_docs, none).collect()} == {0.5}
    assert classifier.keep_good(odd_docs, none).columns == odd_docs.columns


# ------------------------------------------------------------------ n-gram join
def jaccard_classes(docs):
    texts = sorted({t or "" for _, t in docs})
    sets = []
    for t in texts:
        words = t.encode().split()
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    linked = {(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        root[find(i)] = find(j)
    spot, links, copies = {t: i for i, t in enumerate(texts)}, Counter(x for p in linked for x in p), Counter(t or "" for _, t in docs)
    lowest = {}
    for doc, t in docs:
        r = find(spot[t or ""])
        lowest[r] = min((x for x in (lowest.get(r), doc) if x is not None), default=None)
    rows = [(doc, lowest[find(spot[t or ""])], links[spot[t or ""]], copies[t or ""]) for doc, t in docs]
    return rows, list(lowest.values())


def near_copies(rng, count):
    """A chain and a crowd of near copies beside other texts."""
    words = [f"w{i}" for i in range(400)]
    crowd = [" ".join(w if rng.random() > 0.004 else f"v{rng.random()}" for w in words) for _ in range(count)]
    chain = [" ".join([f"c{k}" for k in range(i * 6, i * 6 + 200)]) for i in range(6)]
    return crowd + chain + [" ".join(f"u{i}_{k}" for k in range(40)) for i in range(20)]


@pytest.mark.parametrize("chunk", [7, 512])
def test_join_matches_brute_force(spark, odd_docs, odd_rows, chunk, monkeypatch):
    import random

    monkeypatch.setattr(ngram_join, "BUCKET_CHUNK", chunk)
    monkeypatch.setattr(ngram_join, "FAMILY_CHUNK", chunk)
    made = [(100 + i, t) for i, t in enumerate(near_copies(random.Random(2), 60))]
    extra = spark.createDataFrame(made, "doc_id bigint, text string")
    docs = odd_docs.select("doc_id", "text").unionByName(extra)
    expected, _ = jaccard_classes([(r[0], r[1]) for r in odd_rows] + made)
    assert sorted(map(tuple, ngram_join.near_duplicates(docs).collect()), key=key) == sorted(expected, key=key)


def test_one_row_of_each_class_stays(odd_docs, odd_rows, no_docs):
    kept = ngram_join.keep_one_each(odd_docs)
    assert kept.columns == odd_docs.columns
    _, firsts = jaccard_classes([(r[0], r[1]) for r in odd_rows])
    order = lambda c: (c is None, c)
    assert sorted((r.doc_id for r in kept.collect()), key=order) == sorted(firsts, key=order)
    assert ngram_join.keep_one_each(no_docs).count() == 0 and ngram_join.near_duplicates(no_docs).count() == 0


def test_pruning_limits_follow_the_posterior():
    limits = ngram_join.least_matches(0.8, 1e-6)
    assert [n for n, _ in limits] == list(range(16, 129, 16)) and all(a[1] <= b[1] for a, b in zip(limits, limits[1:]))
    rng = np.random.default_rng(0)
    left = rng.integers(0, 2**16, (1, 128), np.uint16)
    right = np.where(rng.random((2000, 128)) < 0.8, left, rng.integers(0, 2**16, (2000, 128), np.uint16))
    assert ngram_join.surviving(left, right, limits).all()
    assert not ngram_join.surviving(left, rng.integers(0, 2**16, (2000, 128), np.uint16), limits).any()
