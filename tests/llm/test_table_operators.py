import re
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from graniteflow.llm import chat, mixing, packing, queries, url_filter

SMALL = "/root/testdata/sf0.001"
key = lambda row: tuple((x is None, x) for x in row)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SMALL)
    found = con.execute(queries.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(names).collect()), key=key) == sorted(found.fetchall(), key=key)


def test_every_number_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5


# ------------------------------------------------------------------ mixing
def targets(sizes, weights, share=1.5, cap=2.0):
    left, out = share * sum(sizes), {}
    live = list(range(len(sizes)))
    while live:
        total = sum(weights[i] for i in live)
        above = [i for i in live if left * weights[i] / total > cap * sizes[i]]
        if not above:
            return {**out, **{i: left * weights[i] / total for i in live}}
        for i in above:
            out[i] = cap * sizes[i]
        left -= sum(out[i] for i in above)
        live = [i for i in live if i not in above]
    return out


def test_mix_of_odd_rows(odd_docs, odd_rows, no_docs):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for r in odd_rows:
        sizes[r[3]] += count(r[1])
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goal = targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])
    goal = {s: goal[i] for i, s in enumerate(order)}
    rows = mixing.mix(odd_docs, carry=["source"]).collect()
    assert sorted([(r.doc_id, r["size"]) for r in rows], key=key) == sorted([(r[0], count(r[1])) for r in odd_rows], key=key)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source]) and 0 <= r.taken <= 2 * r["size"]
        assert r.taken % max(1, r["size"]) == 0
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 + 1 and taken[s] <= 2 * sizes[s] for s in order)
    assert sum(goal.values()) == pytest.approx(1.5 * sum(sizes.values()))
    again = mixing.mix(odd_docs.repartition(5), carry=["source"]).collect()
    assert sorted(map(tuple, again), key=key) == sorted(map(tuple, rows), key=key)
    assert mixing.mix(no_docs).count() == 0


def test_mixed_rows_hold_the_words_taken(odd_docs):
    rows = mixing.mixed_rows(odd_docs)
    assert rows.columns == odd_docs.columns
    words = Counter()
    for r in rows.collect():
        words[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    plan = Counter()
    for r in mixing.mix(odd_docs, carry=["source"]).collect():
        plan[r.source] += r.taken
    assert words == +plan


def test_mixed_rows_are_whole_documents(spark, odd_docs, odd_rows):
    got = Counter((r.doc_id, r.text, r.source, r.n_chars) for r in corpus_pipeline.mixed(spark, odd_docs, SMALL).collect())
    given = Counter((r[0], r[1], r[3], r[4]) for r in odd_rows)
    assert got and all(k in given and n <= 2 * given[k] for k, n in got.items())


# ------------------------------------------------------------------ url filter
URLS = [
    "http://net/", "http://net", "http://a.b.NET/x?y#z", "https://sub.example.net/en/1", "https://xexample.net/en/1", "http://example.com/de/", "http://m.example.com/de",
    "http://ORG/fr/1", "http://a.org:80/fr/", "ftp://x.org?q://y/fr/", "nothing", None, "", "://", "http:///fr/", "http://É.org/fr/é", "http://a..net/", "http://.net/", "http://com/de/",
    "x://y://z.net/", "http://example.net/en", "HTTP://Example.Net/en/?#", "http://a.example.net/EN/",
]
MORE = [("allow", "net", "/"), ("block", "a.example.net", "/"), ("allow", "a.example.net", "/e"), ("block", "a.example.net", "/en/x"), (None, "x", "/"), ("block", "org", ""), ("allow", "É.org", "/")]


def judged(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]+", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), len(h), h + p, a) for a, h, p in rules if None not in (a, h, p) and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("rules", [url_filter.RULES, url_filter.RULES + MORE, []])
def test_urls_match_brute_force(spark, rules):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0]), (None, "http://a.example.net/en/x/y")] + [(50 + i, "http://hot.example.net/en/") for i in range(200)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, _stack string, host int")
    table = url_filter.rule_table(spark, rules) if rules else url_filter.rule_table(spark).where("false")
    got = sorted(map(tuple, url_filter.filter_urls(df, table).collect()), key=key)
    assert got == sorted([(i, *judged(u, rules)) for i, u in rows], key=key)
    assert url_filter.filter_urls(df.where("false"), table).count() == 0


# ------------------------------------------------------------------ chat formatting
def show(turns):
    text = mask = ""
    for role, t in turns:
        text += f"<|im_start|>{role}\n{t}<|im_end|>\n"
        mask += f",{len(role) + 13}:0,{len(t) + 10}:{int(role == 'assistant')},1:0"
    return text, mask[1:]


def test_preferences_of_odd_conversations(spark):
    rows = [
        (1, 0, "user", "Hi"), (1, 1, "assistant", "Hello"), (1, 2, "user", "More"), (2, 1, "assistant", "<|im_end|> no"), (2, 0, "system", None), (3, 0, "user", ""),
        (None, 0, None, None), (4, 5, "assistant", "A"), (4, 5, "assistant", "A"), (5, None, "assistant", "Z"), (5, 0, "user", "y"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, _turns string")
    safe = lambda s: (s or "").replace("<|im_", "<| im_")
    talks = defaultdict(list)
    for c, turn, role, text in rows:
        talks[c].append(((turn is not None, turn or 0), safe(role), safe(text)))
    order = sorted(talks, key=lambda c: (c is not None, c or 0))
    talks = {c: [t[1:] for t in sorted(talks[c])] for c in order}
    last = lambda turns: max((i for i, t in enumerate(turns) if t[0] == "assistant"), default=None)
    expected = []
    for c, after in zip(order, order[1:] + order[:1]):
        mine, spot, theirs = talks[c], last(talks[c]), last(talks[after])
        other = mine if spot is None else [*mine[:spot], ("assistant", "" if theirs is None else talks[after][theirs][1])]
        k = next((i for i in range(max(len(mine), len(other))) if mine[i : i + 1] != other[i : i + 1]), len(mine))
        expected.append((c, k, show(mine[:k])[0], *show(mine[k:]), *show(other[k:])))
    got = chat.format_pairs(chat.with_rejected(df), "conv_id").collect()
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    assert chat.format_pairs(chat.with_rejected(df.where("false")), "conv_id").count() == 0


def test_pairs_with_null_sides(spark):
    df = spark.createDataFrame([(1, None, [("user", "a")]), (2, None, None)], "id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")
    got = {r.id: (r.prompt_turns, r.prompt, r.chosen, r.rejected_mask) for r in chat.format_pairs(df, "id").collect()}
    assert got == {1: (0, "", "", "17:0,11:0,1:0"), 2: (0, "", "", "")}


# ------------------------------------------------------------------ pipeline
def test_pipeline_stages_on_odd_rows(spark, odd_docs):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns, docs = docs.columns, stage(spark, docs, SMALL)
        assert docs.columns == columns
    assert packing.pack_documents(docs).count() == corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() > 0


def test_pipeline_keeps_what_each_operator_decides(spark):
    from graniteflow.llm import classifier, ngram_join, rules

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ranker = classifier.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = {r.doc_id for r in classifier.classify(docs, ranker).where("predicted = 1").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    first = corpus_pipeline.good_quality(spark, docs, SMALL)
    assert ids(first) == good
    second = corpus_pipeline.little_repetition(spark, first, SMALL)
    assert ids(second) == {r.doc_id for r in rules.judge(first).where("kept").collect()}
    third = corpus_pipeline.one_of_each_class(spark, second, SMALL)
    assert sorted(r.doc_id for r in third.collect()) == sorted({r.class_id for r in ngram_join.near_duplicates(second).collect()})
    pieces = corpus_pipeline.run(spark, SMALL)
    taken = mixing.mixed_rows(third)
    assert pieces.where("piece = 0").count() == taken.count()
