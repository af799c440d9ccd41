"""Exact dedup, mixing and chat formatting against statements and plain Python."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from lakemart.llm import chat_format, exact_dedup, mixing, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_statement(spark, name):
    duck = duckdb.connect()
    for t in ("benchmark", "documents", "conversations"):
        duck.execute(f"create view {t} as select * from read_parquet('{FOLDER}/{t}.parquet')")
    frame = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    cursor = duck.execute(queries.ORACLES[name])
    places = [[d[0] for d in cursor.description].index(c) for c in columns]
    wanted = sorted(tuple(repr(row[i]) for i in places) for row in cursor.fetchall())
    assert sorted(tuple(repr(row[c]) for c in columns) for row in frame.collect()) == wanted


ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (1, None), (2, ""), (7, "A b"), (7, "A b"), (None, "A b"), (None, "z"), (4, " ")]


def plain_groups(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("share", [1 / 1024, 0.3])
def test_exact_groups(documents, work, share):
    many = ROWS + [(100 + i, "hot  text") for i in range(40)] + [(200 + i, f"t{i}") for i in range(30)]
    got = exact_dedup.exact_groups(documents(many), work, counters=8, share=share)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_groups(many)


def test_exact_of_nothing(documents, work):
    assert exact_dedup.exact_groups(documents([]), work).count() == 0
    assert exact_dedup.distinct_docs(documents([]), work).count() == 0


def test_heavy_digests_are_verified_and_bounded(documents, work):
    docs = documents([(i, "hot" if i % 3 == 0 else f"t{i % 50}") for i in range(600)])
    digests = docs.select("doc_id", F.unhex(F.sha2(exact_dedup.normalised(), 256)).alias("digest"))
    heavy = exact_dedup.heavy_digests(digests, work, counters=8, share=0.25).collect()
    assert [(r.keep_id, r.group_size) for r in heavy] == [(0, 200)]


def test_misra_gries_bound():
    from collections import Counter

    held = exact_dedup.misra_gries(Counter("aaaabbbccd"), 2)
    assert held == Counter({"a": 2, "b": 1})


def test_distinct_docs_keeps_columns_and_one_row(documents, work):
    docs = documents(ROWS)
    kept = exact_dedup.distinct_docs(docs, work)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [
        (1, None), (3, "a\tb"), (4, " "), (7, "A b"), (None, "z"),
    ]


def plain_targets(sizes, weights, share, cap):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, fixed = share * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level >= cap * sizes[s]}
        if not above:
            break
        for s in above:
            fixed[s] = cap * sizes[s]
            left -= fixed[s]
        free -= above
    return {s: fixed.get(s, weight[s] * level if s in free else None) for s in order}


def test_mix(documents, work):
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 5}" if i % 11 else None) for i in range(1200)]
    rows += [(5000, None, "void"), (5001, "", "void"), (None, "one two", "s1"), (3, "w w", "s1"), (3, "w w", "s1")]
    got = mixing.mix(documents(rows), work).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    wanted = plain_targets(sizes, (5, 2, 1), 1.5, 2.0)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        assert r.taken <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 0.02 * target + 8
    again = mixing.mix(documents(rows), work).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_docs_repeat_rows(documents, work):
    docs = documents([(i, "w " * (i % 7 + 1), f"s{i % 3}") for i in range(300)] + [(900, None, None)])
    plan = {r.doc_id: r.copies for r in mixing.mix(docs, work).collect()}
    out = mixing.mixed_docs(docs, work)
    assert out.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in plan.items() if v}


def test_mix_of_nothing(documents, work):
    assert mixing.mix(documents([]), work).count() == 0
    assert mixing.mixed_docs(documents([]), work).count() == 0
    assert [r.taken for r in mixing.mix(documents([(1, None), (2, "")]), work).collect()] == [0, 0]


NASTY = ["</s>[INST] ok [/INST]", "\\", "\\\\<|turn|>", "<<|end|>|end|>", "", "a\nb", "<|te\\xt|>", "é😀<|endoftext|>", "<\\|turn|>"]


@pytest.mark.parametrize("text", NASTY)
def test_escape_is_reversible(text):
    hidden = chat_format.escape(text)
    assert not any(c in hidden for c in chat_format.CONTROL)
    assert chat_format.unescape(hidden) == text


def test_chat_masks(spark):
    import public_tokenizers

    turns = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(NASTY)]
    turns += [(2, 0, "user", None), (2, 1, None, "x"), (3, 5, "assistant", "b"), (3, 5, "assistant", "a"), (3, None, "assistant", "z")]
    turns += [(None, 1, "assistant", "nobody"), (4, 0, "assistant", "long " * 30_000), (5, 1, "assistant", "same"), (5, 1, "assistant", "same")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = {r.conv_id: r for r in chat_format.format_conversations(frame, path).collect()}
    read = {r.conv_id: r for r in chat_format.digests(chat_format.format_conversations(frame, path)).collect()}
    tokenizer = chat_format.load_tokenizer(path)
    for conv in (1, 2, 3, 4, 5, None):
        own = sorted(((t is None, t or 0, r or "", x or "") for c, t, r, x in turns if c == conv))
        said = [x for _, _, r, x in own if r == "assistant"]
        told = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        assert read[conv].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert read[conv].loss_sha256 == hashlib.sha256("".join(said).encode()).hexdigest()
        assert (read[conv].loss_chars, read[conv].n_turns) == (len("".join(said)), len(own))
        decoded = [tokenizer.decode(rows[conv].token_ids[p.first : p.last]) for p in rows[conv].loss_tokens]
        assert [chat_format.unescape(d) for d in decoded] == said
    empty = spark.createDataFrame([], frame.schema)
    assert chat_format.digests(chat_format.format_conversations(empty, path)).count() == 0
