"""Centroid clustering, spelling variants and license scans against plain versions, and reads of operators from any plan."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.llm import centroids, licenses, mixing, queries, spelling, topk, warc
from tidemill.session import scratch_path


def rows(df, *names):
    return sorted(((tuple(r[n] for n in names)) for r in df.collect()), key=repr)


# Centroids


def plain_clusters(vectors, k, rounds, width, seed=1):
    import hashlib

    kept = []
    for i, v in vectors:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [max(-(1 << 63), min((1 << 63) - 1, math.floor(64 * x))) if math.isfinite(64 * x) else (1 << 63) - 1 for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    model = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(model))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        for n, group in groups.items():
            model[n] = [sum(column) // len(group) for column in zip(*group, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    inside = defaultdict(int)
    for _, far, n in found:
        inside[n] += far
    small = lambda x: x if x < 1 << 63 else None
    cluster_sum = lambda n: None if any(small(f) is None for _, f, m in found if m == n) else small(inside[n])
    whole = None if any(small(f) is None for _, f, _ in found) else small(sum(inside.values()))
    return [(i, n, small(far), cluster_sum(n), whole, model[n]) for i, far, n in found]


@pytest.mark.parametrize("high", [1.0, 3e7, 1e15, 1e300])
def test_clusters_equal_plain_rounds(spark, high):
    r = np.random.default_rng(5)
    made = [(i, (r.integers(-4, 5, 6) * high / 8).tolist()) for i in range(200)]  # coarse values: many ties
    made += [(7, made[7][1]), (7, made[7][1]), (None, made[3][1]), (900, None), (901, [1.0] * 5), (902, [None] + [1.0] * 5), (903, [math.nan] * 6), (904, [math.inf] * 6), (905, [])]
    table = spark.createDataFrame(made, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("x")).withColumn("id", F.lit(0))
    found = centroids.cluster(table, k=9, rounds=2, width=6)
    got = [(r.id, r.cluster, r.distance, r.cluster_inertia, r.inertia, list(r.centroid)) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(plain_clusters(made, 9, 2, 6), key=repr)
    assert centroids.cluster(table.where("vec_id < 0"), width=6).count() == 0
    few = centroids.cluster(table.where("vec_id in (1, 2)"), k=9, rounds=1, width=6)
    assert sorted(x.distance for x in few.collect()) == [0, 0]


def test_the_walk_stops_early():
    r = np.random.default_rng(6)
    model = r.integers(-1000, 1000, (200, 2)).tolist()
    x = r.integers(-1000, 1000, (500, 2)).astype(float)
    number, best, measured = centroids.SortedCentroids(model, np.float64).nearest(x)
    far = ((x[:, None] - np.array(model)[None]) ** 2).sum(axis=2)
    assert (number == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
    assert measured < far.size / 4


@given(st.lists(st.lists(st.integers(-3, 3), min_size=3, max_size=3), min_size=1, max_size=9), st.lists(st.lists(st.integers(-4, 4), min_size=3, max_size=3), min_size=1, max_size=9))
@settings(max_examples=60, deadline=None)
def test_nearest_with_ties(model, vectors):
    for kind in (np.float64, np.int64, object):
        number, best, _ = centroids.SortedCentroids(model, kind).nearest(np.array(vectors, kind))
        far = ((np.array(vectors)[:, None] - np.array(model)[None]) ** 2).sum(axis=2)
        assert number.tolist() == far.argmin(axis=1).tolist() and [int(b) for b in best] == far.min(axis=1).tolist()


def test_model_size_is_bounded(spark):
    table = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="exceed"):
        centroids.cluster(table, k=1 << 15, width=64)


# Spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_words(docs, every):
    n = Counter()
    for doc_id, text in docs:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if every and doc_id is not None and h % every == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 5:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 3}


def plain_groups(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return out


@pytest.fixture(scope="module")
def misspelt(spark, odd, documents):
    made = spark.createDataFrame(
        [(k, "wörter Wörter WÖRTER wÖrter colour color colours " * (1 + k % 3) + "abcde abcdf abxde abcd bcde abccde " * (k % 2) + "x" * (100 + k % 3), "s") for k in range(12)],
        "doc_id long, text string, source string",
    )
    return odd.select("doc_id", "text", "source").unionByName(made).unionByName(documents.select("doc_id", "text", "source").where("doc_id < 40")), odd.where("doc_id < -1")


@pytest.mark.parametrize("limits", [{}, {"TILE_ROWS": 3, "TASK_ROWS": 50, "CELLS": 16, "PIECE": 50, "WORDS_HELD": 20}])
def test_spelling_groups(misspelt, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(spelling, name, value)
    docs, none = misspelt
    for every in (0, 7):
        want = plain_words([(r.doc_id, r.text) for r in docs.collect()], every)
        words = spelling.count_words(docs, misspell_every=every)
        assert dict(rows(words, "word", "n")) == want
        found = spelling.group_spellings(words)
        assert rows(found, "word", "n", "n_near", "form", "form_n", "root") == sorted(plain_groups(want), key=repr)
    assert spelling.group_spellings(spelling.count_words(none)).count() == 0


@given(st.lists(st.text(alphabet="abé", min_size=5, max_size=7), max_size=40))
@settings(max_examples=40, deadline=None)
def test_a_tile_finds_every_edit_once(found):
    import pandas as pd

    words = sorted(set(found))
    n = {w: 3 + k % 4 for k, w in enumerate(words)}
    tiles = [(m, head, hash((m, head, w[: m // 2] if head else w[-(m // 2) :])) % 5, 0, 0, 0, w, n[w]) for w in words for m in (len(w), len(w) + 1) for head in (True, False)]
    group = pd.DataFrame(tiles, columns=["m", "head", "tile", "left", "right", "own", "word", "n"])
    got = {r.word: (r.n_near, r.best) for r in spelling.near_of_tiles(group).itertuples()} if tiles else {}
    want = {w: [v for v in words if one_edit(w, v)] for w in words}
    assert got == {w: (len(vs), min(vs, key=lambda v: (-n[v], v))) for w, vs in want.items() if vs}


# Licenses


def plain_scan(text, templates, phrases, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t))
    words, spans = split(text or ""), []
    for label, body in templates:
        other = split(body)
        hits = defaultdict(set)
        for p in range(len(words) - k + 1):
            for q in range(len(other) - k + 1):
                if words[p : p + k] == other[q : q + k]:
                    hits[p - q].add(q)
        merged = []
        for d in sorted(hits):
            if merged and d - merged[-1][-1] <= licenses.GAP:
                merged[-1].append(d)
            else:
                merged.append([d])
        for run in merged:
            covered = {q + i for d in run for q in hits[d] for i in range(k)}
            start, end = min(d + q for d in run for q in hits[d]), max(d + q for d in run for q in hits[d]) + k
            if len(covered) >= 0.75 * len(other) and len(covered) >= 0.5 * (end - start):
                spans.append((start, end, label, len(covered) / len(other), False))
    for label, body in phrases:
        other = split(body)
        spans += [(p, p + len(other), label, 1.0, True) for p in range(len(words)) if words[p : p + len(other)] == other]
    base = sorted(s for s in spans if s[4])
    return (
        len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None, sorted({s[2] for s in base}),
        sorted({s[2] for s in spans}), max((s[3] for s in spans), default=0.0), sorted(s[:4] for s in spans),
    )


def test_license_scan(spark, odd, documents):
    longest = max((t for _, t in licenses.TEMPLATES), key=len)
    words = longest.split()
    texts = [
        "CC BY cc-by general public  license ALL RIGHTS RESERVED all rights", "É" + "cc by", "ccK by cc by", "x " * 20_000 + "cc by " * 300,
        longest, longest + " " + longest, " ".join(words[:10] + ["and", "also"] + words[10:]), " ".join(words[:9] + words[11:]), " ".join(words[::-1]),
        " ".join(words[: len(words) // 2]), "some text. Released under the MIT License. Released under the MIT License!", "cc", "by", "All rights", "",
    ]
    made = spark.createDataFrame([(k, t, "a", 1, "z") for k, t in enumerate(texts + [None, texts[0]])], "doc_id long, text string, labels string, row int, words string")
    for docs in (made, odd, documents):
        want = [(r.doc_id, *plain_scan(r.text, licenses.TEMPLATES, licenses.PHRASES, 3)) for r in docs.collect()]
        found = licenses.scan_licenses(docs).collect()
        got = [(*r[:5], list(r.base_labels), list(r.labels), r.score, [tuple(s) for s in r.spans]) for r in found]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert licenses.scan_licenses(odd.where("doc_id < -1")).count() == 0
    with pytest.raises(ValueError, match="characters"):
        licenses.scan_licenses(made, templates=[("long", "x" * (1 << 21))])


def test_license_scan_stays_in_the_jvm(spark, small):
    plan = queries.op13_licenses(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD|CartesianProduct|NestedLoop", plan)


# Reads of operators


def test_top_k_can_be_pruned_and_counted(spark, small):
    found = topk.top_k(spark.read.parquet(f"{small}/embeddings.parquet"), F.col("id") % 20 == 0)
    n = len(found.collect())
    assert found.count() == n and not found.isEmpty()
    assert all(len(found.select(c).collect()) == n for c in found.columns)


@pytest.mark.parametrize("high", [1e7, 1e17, 1e30])
def test_top_k_of_large_components(spark, high):
    r = np.random.default_rng(8)
    made = [(i, (r.normal(0, 1, 5) * high).tolist()) for i in range(60)]
    found = topk.top_k(spark.createDataFrame(made, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0, k=4)
    vectors = [(i, [max(-topk.LARGEST, min(topk.LARGEST, math.floor(64 * x))) for x in v]) for i, v in made]
    want = []
    for i, v in vectors:
        if i % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in vectors if j != i)[:4]
            want += [(i, place + 1, j, -s if -s < 1 << 63 else None) for place, (s, j) in enumerate(best)]
    assert rows(found, "query_id", "rank", "id", "score") == sorted(want, key=repr)


@pytest.fixture
def shuffled_small(spark):
    """Joins that split their two sides in many small partitions, differently where columns are pruned."""
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "4k")
    spark.conf.set(names[1], "-1")
    yield
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def test_warc_of_joined_pages(spark, shuffled_small):
    made = [(k % 7000, f"u{k % 3}" if k % 5 else None, f"p{k % 900}" if k % 4 else None) for k in range(9000)]
    made += [(8000, "u", "twice")] * 5 + [(None, "u", "p1")] * 3
    spark.createDataFrame(made, "page_id long, url string, html string").write.parquet(path := scratch_path(spark, "pages"))
    pages = spark.read.parquet(path)
    joined = pages.join(pages.select("page_id").distinct().withColumn("more", F.lit(1)), "page_id", "left")
    last = defaultdict(lambda: -1)
    for page_id, _, html in made:
        last[html or ""] = max(last[html or ""], -1 if page_id is None else page_id)
    folder = warc.write_archives(joined, scratch_path(spark, "warc"))
    read = warc.read_archives(spark, folder)
    responses = {bytes(r.payload).decode(): r.record_id for r in read.where("record_type = 'response'").collect()}
    assert responses == {html: f"urn:page:{page_id}" for html, page_id in last.items()}
    assert read.where("record_type = 'response'").count() == len(last) and read.count() == len(made)


def test_mixing_holds_rare_quality_in_many_bins(spark, monkeypatch):
    """Documents of very low quality draw keys far from the others'; still each bin is a small share."""
    made = [(k, "a " * 10 + str(k % 7), "s" if k % 3 else "t", 0.002 if k % 50 else 1.0) for k in range(4000)]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string, good double")
    monkeypatch.setattr(mixing, "ROWS_PER_BIN", 100)
    seen = []

    def kept(df, label="stage"):
        out = mixing_materialize(df, label)
        seen.append((label, out))
        return out

    mixing_materialize = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", kept)
    found = mixing.mix(docs, quality_col="good").collect()
    drawn = next(df for label, df in seen if label == "drawn")
    assert max(r["count"] for r in drawn.groupBy("bin").count().collect()) < 400
    taken = defaultdict(int)
    for r in found:
        taken[(r.source_size, r.target)] += r.size * r.times
    assert all(abs(words - target) <= 6 for (_, target), words in taken.items())
    ids = Counter(r.doc_id for r in mixing.mixed_documents(docs, quality_col="good").collect())
    assert ids == Counter({r.id: r.times for r in found if r.times})


# Long texts, hot ids and ownership


def test_long_texts_are_cut_where_classes_change(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tidemill.llm import token_counts
    from tidemill.llm.tokenizer_files import load, safe_pieces

    path = public_tokenizers.path(queries.COUNTED_BY)
    library, encoder = Tokenizer.from_file(path), load(open(path, "rb").read(), ".json")
    chinese = "今天天气很好，我们去公园散步。" * 70_000  # over 1,000,000 characters without a space
    texts = [chinese, "x1" * 200_000, "a<|endoftext|>b," * 9_000, "don't we'll 'tis\n\n  x\t1,5 é!'s " * 5_000, "7" * 70_000, "word" * 9_000]
    for text in texts[:4]:
        found = safe_pieces(text, 1 << 10, encoder.cuts, encoder.whole)
        assert "".join(found) == text and max(map(len, found)) < 1 << 11
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path, piece_chars=1 << 10).collect()} == want


@given(st.text(alphabet=st.sampled_from("ab1 '\n\t.,!<|>é漢字。、ßs-_́\x1c"), max_size=200))
@settings(max_examples=150, deadline=None)
def test_class_cuts_never_change_ids(text):
    import public_tokenizers

    from tidemill.llm.tokenizer_files import loaded, safe_pieces

    encoder = loaded(open(public_tokenizers.path(queries.COUNTED_BY), "rb").read(), ".json")
    pieces = safe_pieces(text + "<|endoftext|>" + text, 3, encoder.cuts, encoder.whole)
    assert [i for ids in encoder.encode(pieces) for i in ids] == encoder.encode([text + "<|endoftext|>" + text])[0]


def test_hot_ids_fill_several_token_files(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tidemill.llm import token_files

    path = public_tokenizers.path(queries.STORED_BY)
    made = [(k, f"text number {k}") for k in range(200)] + [(50, f"hot {k}") for k in range(300)] + [(None, f"none {k}") for k in range(300)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    folder = token_files.write_token_files(docs, scratch_path(spark, "tokens"), path, end_id=1, partitions=16)
    shards = [s["n_docs"] for s in __import__("json").loads(open(f"{folder.removeprefix('file:')}/manifest.json").read())["shards"]]
    assert sum(shards) == len(made) and max(shards) < 150
    read = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    ids = [r.id for r in read]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))
    library, start, want = Tokenizer.from_file(path), 0, Counter()
    for i, text in made:
        want[(i, np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u2").tobytes())] += 1
    for r in read:
        assert r.start == start
        start += r.n_tokens
    assert Counter((r.id, bytes(r.ids)) for r in read) == want
    with pytest.raises(Exception, match="out of bounds|out of range|overflow"):
        token_files.write_token_files(docs, scratch_path(spark, "tokens"), path, kind="u1")


def test_ownership_verdicts_against_plain_counts(spark):
    from tidemill.llm import secrets

    r = np.random.default_rng(9)
    letters = np.array(list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789"))
    value = lambda: "".join(r.choice(letters, 24)) + "1aZ"
    one, two, three, spread, dull = value(), value(), value(), value(), "aaaa1111aaaa1111aaaaA1"
    rows_ = [(1, one, "a", "r1"), (2, two, "a", "r1"), (3, two, "b", "r2"), (4, three, "a", "r1"), (5, three, "b", "r1"), (6, three, None, "r1")]
    rows_ += [(100 + k, spread, "a", f"r{k}") for k in range(20)] + [(200, dull, "a", "r1"), (201, None, "a", "r1")]
    docs = spark.createDataFrame([(i, None if t is None else f"see {t} here", o, p) for i, t, o, p in rows_], "doc_id long, text string, source string, repo string")
    holders = defaultdict(set)
    for _, t, o, p in rows_:
        holders[t].add((o, p))
    for x in secrets.find_secrets(docs, repository_col="repo").collect():
        t = next(t for i, t, _, _ in rows_ if i == x.id)
        owners, repositories = len({o for o, _ in holders[t]}), len(holders[t])
        live = t not in (None, dull) and owners < 3 and repositories < 20
        assert (x.spans != "") == live == bool(x.n_live)
        if live:
            assert (x.n_owners, x.n_repositories) == (owners, repositories)


# The pipeline as a whole


def test_pipeline_run_equals_plain_composition(spark, small, tmp_path):
    import hashlib
    import os
    import shutil

    import public_tokenizers
    import tiktoken

    import corpus_pipeline
    from tidemill.llm import bpe, crf

    shutil.copy(f"{small}/labels.parquet", tmp_path / "labels.parquet")
    given_docs = spark.read.parquet(f"{small}/documents.parquet")
    base = given_docs.collect()
    more = [r for r in base if r.doc_id % 9 == 0]
    made = [tuple(r) for r in base] + [(5000 + r.doc_id, r.text.upper(), *r[2:]) for r in more] + [(7000 + r.doc_id, r.text + " one more word at the end", *r[2:]) for r in more]
    made += [(9000, None, "en", None, 0), (9001, "", "en", None, 0)]
    spark.createDataFrame(made, given_docs.schema).repartition(4).write.parquet(path := str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(path)

    chain = crf.train(docs, spark.read.parquet(str(tmp_path / "labels.parquet")))
    kept = [r for r in crf.score_documents(docs, chain).collect() if r.score >= 0.5]
    last = {}
    for r in kept:
        text = (r.text or "").encode().lower()
        if text not in last or r.doc_id > last[text].doc_id:
            last[text] = r
    unique = list(last.values())
    sets = []
    for r in unique:
        words = (r.text or "").encode().lower().split()
        sets.append({b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(unique)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(unique)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((top(i), top(j)), key=lambda k: unique[k].doc_id)
                group[b] = a
    alone = [r for i, r in enumerate(unique) if top(i) == i]
    assert len(base) > 100 and 0 < len(alone) < len(unique) < len(kept) < len(made)

    mixed = mixing.mix(spark.createDataFrame([tuple(r)[:5] for r in alone], given_docs.schema))
    times = {r.id: r.times for r in mixed.collect()}
    ranks = bpe.parse_ranks(open(public_tokenizers.path(queries.BPE_RANKS), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for r in alone:
        ids = library.encode_ordinary(r.text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want[(r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest())] += times[r.doc_id]
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(tuple(r)[:4] for r in found.collect()) == +want
    assert os.path.isdir(path)
