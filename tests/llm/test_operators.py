"""Operators without an exact oracle, special inputs, and the whole pipeline."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridtally.llm import queries as Q
from gridtally.llm.bpe import bpe_decode, bpe_encode
from gridtally.llm.common import cut
from gridtally.llm.components import connected_components
from gridtally.llm.decontaminate import find_contamination
from gridtally.llm.html_extract import compact_trees, extract_text, pick_references
from gridtally.llm.licenses import scan_licenses
from gridtally.llm.line_dedup import build_index, delete, drop_repeated_lines, insert
from gridtally.llm.quality_rules import judge, keep_good
from gridtally.llm.sharding import lookup_table, place
from gridtally.llm.simhash import near_dedup, near_links
from gridtally.llm.toxicity import _marked, score_toxicity, train_toxicity
from gridtally.plans.session import staging_path
from tests.conftest import SF01
from tests.llm import brute
from tests.llm.conftest import odd_documents


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(7, 7)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    want = {(i, 0) for i in range(1, 61)} | {(x, 100) for x in range(101, 160)}
    assert {tuple(r) for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_shards_are_dealt_anew_without_losing_links(spark):
    import random

    rng = random.Random(9)
    centre = rng.getrandbits(63)
    codes = {centre}
    while len(codes) < 400:  # one dense cloud, in which most codes share shards
        c = rng.choice([centre, rng.choice(sorted(codes))])
        codes.add(c ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)))
    points = spark.createDataFrame([(c,) for c in codes], "fp long")
    want = brute_components(codes)
    for bound in (2048, 60):
        links = near_links(points, 2, shard_bound=bound)
        got = connected_components(links).collect()
        roots = {c: c for c in codes} | {r.node: r.root for r in got}
        assert Counter(roots.values()) == Counter(want.values())
        assert links.count() < 6 * 7 * 6 * len(codes)


def brute_components(codes):
    codes, root = sorted(codes), {}
    for c in codes:
        if c not in root:
            todo = [c]
            root[c] = c
            while todo:
                x = todo.pop()
                for y in codes:
                    if y not in root and (x ^ y).bit_count() <= 2:
                        root[y] = c
                        todo.append(y)
    return root


def test_line_index_is_reversible(spark):
    line = "a line that is certainly long enough {}"
    docs = [(d, "\n".join(line.format(k) for k in range(12) if (d + k) % 3)) for d in range(40)]
    new = [(d, "\n".join([line.format(d % 5), line.format(99), "x"])) for d in range(100, 120)]
    schema = "doc_id long, text string"
    first, second = (spark.createDataFrame(x, schema) for x in (docs, new))
    both = first.unionByName(second)

    def kept(index, table):
        return sorted(map(tuple, drop_repeated_lines(
            table, index, "doc_id", "text", [F.col("doc_id")], ("n", "k", "t")).collect()))

    index = build_index(first, "doc_id", "text")
    alone = kept(index, first)
    assert alone == sorted(brute.line_dedup(docs))
    grown = insert(index, second, "doc_id", "text")
    assert kept(grown, both) == sorted(brute.line_dedup(docs + new))
    back = delete(grown, second.select("doc_id"), "doc_id")
    assert kept(back, first) == alone
    counts = [{tuple(r) for r in x.refs.collect()} for x in (index, back)]
    assert counts[0] == counts[1]
    assert delete(back, first.select("doc_id"), "doc_id").refs.count() == 0


def test_wrapper_induction_drops_unmarked_template(spark):
    page = ("<html><body><div>Site name</div><div><span>Home</span></div><div><h1>T{0}</h1>"
            "<p>story {0} has its own words {1}</p>{2}</div><div>All rights reserved here</div>")
    pages = [(i, f"http://Host.example/{i}", page.format(i, "word " * i, "<p>more</p>" * (i % 3)))
             for i in range(12)]
    pages += [(50, "http://lonely.example/", page.format(50, "", "")), (51, None, None), (52, "x", "")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_text(df, "url", "html", [F.col("page_id")]).collect()}
    for i in range(12):
        want = [f"T{i}", " ".join(f"story {i} has its own words {'word ' * i}".split())]
        assert got[i].split("\n") == want + ["more"] * (i % 3), i
    assert got[50].startswith("Site name\nHome\nT50")  # nothing to compare it with
    assert got[51] == got[52] == "" and len(got) == 15


@pytest.mark.parametrize("odd_page", [None, "<html><body><p>moved</p></body></html>"])
def test_odd_pages_do_not_switch_off_their_hosts_wrapper(spark, odd_page):
    page = ("<html><body><div>Site name</div><div><h1>T{0}</h1><p>story {0} is told here</p>"
            "<p>This long notice stands below every story of the site, word for word.</p></div>{1}")
    extra = "<section><p>Second layout only</p></section>"
    pages = [(i, f"http://h.example/{i}", page.format(i, extra if i % 2 else "")) for i in range(16)]
    pages.append((99, "http://h.example/odd", odd_page))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_text(df, "url", "html", [F.col("page_id")]).collect()}
    for i in range(16):
        assert got[i] == f"T{i}\nstory {i} is told here", i
    assert got[99] == ("moved" if odd_page else "")


def test_references_are_fitted_on_all_pages_of_a_large_host(spark):
    page = "<html><body><div><p>story {0} is told here</p><p>second part of {0}</p></div></body></html>"
    rare = ("<html><body><section><p>This notice stands on every page of the kind</p>"
            "<p>letter {0} is printed here</p></section></body></html>")
    pages = [(i, f"http://h.example/{i}", page.format(i)) for i in range(1500)]
    pages += [(2000 + i, f"http://h.example/r{i}", rare.format(i)) for i in range(4)]
    pages += [(3000 + i, f"http://h.example/o{i}", f"<table><tr><td>odd {i}</table>") for i in range(3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = pick_references(cut(compact_trees(df, "url", "html"))).collect()
    assert len({r.layout for r in found}) == 2  # the sample of 256 pages missed the rare layout
    got = {r.page_id: r.text for r in extract_text(df, "url", "html", [F.col("page_id")]).collect()}
    assert len(got) == len(pages) and got[7] == "story 7 is told here\nsecond part of 7"
    for i in range(4):
        assert got[2000 + i] == f"letter {i} is printed here"
    assert [got[3000 + i] for i in range(3)] == [f"odd {i}" for i in range(3)]


def test_pages_query_keeps_articles_only(spark):
    rows = Q.op6_html_extraction(spark, SF01).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    import html
    import re

    for r in rows:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        want = html.unescape(re.sub("<[^>]+>", " ", body)).split()
        assert r.text.split() == want and r.n_chars == len(r.text)
        assert "  " not in r.text and not any(x.strip() != x or not x for x in r.text.split("\n"))


@pytest.mark.parametrize(("query", "label", "most_errors"), [
    (Q.op4_toxicity, "toxic", 0.05), (Q.op7_quality, "quality", 0.08)])
def test_classifiers_on_held_out_rows(spark, query, label, most_errors):
    rows = query(spark, SF01)
    assert rows.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert len(held) > 40 and all(0 <= r.score <= 1 for r in held)
    errors = sum(r.predicted != r[label] for r in held) / len(held)
    assert errors <= most_errors, errors


def test_toxic_documents_are_found_among_held_out_rows(spark):
    folder = SF01.replace("sf0.01", "sf0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held = Q.op4_toxicity(spark, folder).where("held_out").join(labels, "doc_id").collect()
    toxic = [r.predicted for r in held if r.toxic == 1]
    clean = [r.predicted for r in held if r.toxic == 0]
    assert len(toxic) > 90 and sum(toxic) / len(toxic) >= 0.9
    assert sum(clean) / len(clean) <= 0.02


def test_classifiers_ignore_labels_lang_source_and_id_when_scoring(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(50)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    model, cuts = train_toxicity(spark.read.parquet(f"{SF01}/documents.parquet"), labels, "doc_id",
                                 "text", "toxic", "lang", F.lit(True), max_rows=200)
    a = score_toxicity(docs, "text", [F.col("doc_id")], model, F.col("lang"), cuts)
    b = score_toxicity(docs.withColumn("lang", F.lit("xx")), "text", [F.col("doc_id")], model)
    assert ({(r.doc_id, r.score) for r in a.collect()} == {(r.doc_id, r.score) for r in b.collect()})


def test_classifiers_with_odd_documents_and_labels(spark, odd, tmp_path):
    folder = str(tmp_path)
    odd.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, None if i == 20 else i % 2, (i + 1) % 2) for i in range(10, 60)]
    labels += [(None, 1, 1), (41, 0, 1), (41, 1, 0)]
    schema = "doc_id long, quality int, toxic int"
    spark.createDataFrame(labels, schema).write.parquet(f"{folder}/labels.parquet")
    for query in (Q.op4_toxicity, Q.op7_quality):
        rows = query(spark, folder).collect()
        assert len(rows) == len(odd_documents()) and all(0 <= r.score <= 1 for r in rows)
    bare = staging_path(spark, "no_labels")
    odd.write.parquet(f"{bare}/documents.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{bare}/labels.parquet")
    for query in (Q.op4_toxicity, Q.op7_quality):
        assert {(r.score, r.predicted) for r in query(spark, bare).collect()} == {(0.0, 0)}


def test_quality_rules_keep_clean_and_reject_bad(spark):
    rows = Q.op8_quality_rules(spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    seen = rows.where("not base_failed").join(labels, "doc_id").collect()
    assert all(r.kept == bool(r.quality) for r in seen) and len({r.kept for r in seen}) == 2


def test_quality_rules_run_without_python(spark, odd):
    plan = judge(odd, "text", [F.col("doc_id")])
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text


def test_placement_is_a_lookup(spark):
    docs = spark.createDataFrame([(i % 7, i) for i in range(50)] + [(None, 99)],
                                 "doc_id long, shard long")
    got = place(docs, F.col("doc_id"), ["a", "b", "c"], 101).collect()
    table = lookup_table(["a", "b", "c"], 101)
    assert len(got) == 51 and all(table[r.slot] == r.shard for r in got)
    import hashlib

    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
    rows = Q.op9_sharding(spark, SF01).groupBy("shard").count().collect()
    assert len(rows) > 100


def test_marked_rows_hold_all_ids_and_few_others(spark):
    rows = spark.range(-3000, 3000).select(F.col("id").alias("_gt_id"))
    ids = rows.where("_gt_id % 3 = 0")
    got = {r[0] for r in _marked(rows, ids).collect()}
    assert {r[0] for r in ids.collect()} <= got and len(got) < 2050
    assert _marked(rows, ids.limit(0)).count() == 0


def test_thresholds_rest_on_all_labelled_rows(spark):
    rows = [(i, ("vile " if i % 2 else "kind ") * 5 + f"word{i}", "xx" if i < 8 else "en", i % 2)
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    labels = docs.select("doc_id", "toxic")
    model, cuts = train_toxicity(docs.drop("toxic"), labels, "doc_id", "text", "toxic", "lang",
                                 F.lit(True), max_rows=50)
    assert model is not None and set(cuts) == {None, "en", "xx"}
    got = score_toxicity(docs, "text", [F.col("toxic")], model, F.col("lang"), cuts).collect()
    assert all(r.flagged == bool(r.toxic) for r in got)


def test_license_query_lists_all_licences(spark, tmp_path):
    text = ("Dual work, Released under the MIT License. Or take it as Licensed under the Apache "
            "License, Version 2.0. Choose one.")
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.licenses, r.n_matches) for r in
           Q.op10_license_scan(spark, str(tmp_path)).collect()}
    assert got == {1: (["Apache-2.0", "MIT"], 2), 2: ([], 0)}


def test_license_query_finds_planted_lines(spark, odd):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in Q.op10_license_scan(spark, SF01).collect()}
    names = {"Apache License": "Apache-2.0", "MIT License": "MIT", "CC BY-NC 4.0": "CC-BY-NC-4.0",
             "GNU General Public License": "GPL-3.0"}
    planted = 0
    for d, text in docs.items():
        found = {n for k, n in names.items() if k in text}
        planted += bool(found)
        if found:
            assert rows[d].license in found
        else:
            assert rows[d].license is None and rows[d].n_matches == 0
    assert planted > 10
    assert scan_licenses(odd, "text", [F.col("doc_id")]).where("license is not null").count() == 0


def test_every_operator_takes_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    for t in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{SF01}/{t}.parquet").limit(0).write.parquet(f"{folder}/{t}.parquet")
    for name, query in Q.queries().items():
        assert query(spark, folder).count() == 0, name


# ---- pipeline
def brute_pipeline(rows, items, encoding, kept):
    """rows (doc_id, text) after ``kept`` to the result's digests."""
    docs = [(d, t) for d, t in rows if d in kept]
    docs = [(d, t) for d, _, _, t in brute.line_dedup(docs)]
    docs = [(d, t) for (d, t), (_, _, c) in zip(docs, brute.simhash(docs)) if d == c]
    clean = {x[0] for x in brute.contamination(docs, items) if not x[-1]}
    return brute.bpe([(d, t) for d, t in docs if d in clean], encoding)


def test_pipeline_equals_brute_force(spark):
    import public_tokenizers

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    kept = {r.doc_id for r in Q.op8_quality_rules(spark, SF01).where("kept").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    encoding = brute.tokenizer(public_tokenizers.path(Q.VOCABULARY), public_tokenizers.PATTERN)
    want = brute_pipeline([tuple(r) for r in docs.select("doc_id", "text").collect()], items,
                          encoding, kept)
    got = corpus_pipeline.run(spark, SF01)
    assert Counter(map(tuple, got.select("doc_id", "n_tokens", "ids_sha256",
                                         "decoded_sha256").collect())) == Counter(want)
    assert 0 < len(want) < docs.count()


def test_stages_keep_the_columns_and_take_odd_documents(spark, odd):
    docs = cut(odd)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF01)
        assert out.dtypes == odd.dtypes, name
        out.write.parquet(path := staging_path(spark, name))
        assert spark.read.parquet(path).count() <= len(odd_documents())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF01).count() == len(odd_documents())


def test_kept_rows_are_counted_once(spark):
    """The verdict's filter stays above the counts, which it uses many times."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    plan = corpus_pipeline.quality_rules(spark, docs, SF01)._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("sort_array") == 1


@pytest.mark.parametrize("call, results", [
    (lambda d, k: judge(d, "text", k), ["counts", "base_failed", "posterior", "kept"]),
    (lambda d, k: find_contamination(d, d.limit(1), "text", "doc_id", "text", k),
     ["n_words", "spans", "items"]),
    (lambda d, k: scan_licenses(d, "text", k), ["license", "score", "matches"]),
    (lambda d, k: extract_text(d, "source", "text", k), ["text"]),
    (lambda d, k: bpe_decode(bpe_encode(d, "text", k, *Q.tokenizer_files()), "ids",
                             Q.tokenizer_files()[0]), ["ids", "decoded"]),
])
def test_kept_columns_called_like_a_result_give_way(odd, call, results):
    extra = {n: F.lit("mine") for n in (*results, "_gt_n_words", "_gt_k0", "_gt_row", "N_Words")
             if n not in ("text", "N_Words")}
    docs = odd.withColumns(extra).limit(9)
    got = call(docs, [F.col(f"`{c}`") for c in docs.columns])
    names = [c for c in docs.columns if c.lower() not in results] + results
    assert got.columns == names and got.count() == 9
    assert {r["_gt_n_words"] for r in got.select("_gt_n_words").collect()} == {"mine"}


def test_stages_return_columns_with_inner_names_unchanged(odd):
    docs = odd.withColumns({n: F.lit("mine") for n in ("_gt_id", "_gt_row", "_gt_n_words", "_gt_kept")})
    for rows in (near_dedup(docs, "doc_id", "text"), keep_good(docs, "text")):
        assert rows.columns == docs.columns
        assert all(r["_gt_id"] == r["_gt_row"] == r["_gt_n_words"] == r["_gt_kept"] == "mine"
                   for r in rows.collect())
