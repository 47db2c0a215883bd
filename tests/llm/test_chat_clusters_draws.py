"""Chat formatting, centroid clustering and importance resampling against plain restatements."""

import hashlib
import math
import random
import re
import zlib

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from byteloom.llm import centroids, chat, registry, resampling

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_chat_formatting", "op13_importance_resampling"])
def test_query_matches_sql(spark, name):
    result = compare.spark_rows(registry.queries()[name](spark, SF))
    assert compare.difference(result, compare.oracle_rows(compare.connect(SF), registry.oracle_sql()[name])) is None


# --- clustering ----------------------------------------------------------------


def plain_clusters(rows, k, rounds, n, scale=256):
    kept = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == n and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda i: hashlib.sha256(f"2:{'null' if i is None else i}".encode()).hexdigest()
    centers = [v for _, _, v in sorted((key(i), v, v) for i, v in kept)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), no) for no, c in enumerate(centers))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for no in set(at):
            own = [v for (_, v), a in zip(kept, at) if a == no]
            centers[no] = [sum(x) // len(own) for x in zip(*own)]
    return centers, [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(80)]
    rows += [(i, [0.25, -0.25, 0.5, 0.0]) for i in range(200, 260)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, [0.1, 0.2, 0.3, 0.4]), (900, [-1e-9, 0.0, 1e6, -1e6])]
    rows += [(300, None), (301, []), (302, [1.0] * 3), (303, [1.0] * 5), (304, [1.0, None, 1.0, 1.0])]
    rows += [(305, [float("nan"), 1.0, 1.0, 1.0]), (306, [1.0, float("inf"), 1.0, 1.0]), (307, [1.0, -float("inf"), 1.0, 1.0])]
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    schema = "vec_id bigint, embedding array<float>, v string, id string, cluster string, distance string, norm string"
    return rows, spark.createDataFrame([(i, v, *["clash"] * 5) for i, v in rows], schema).repartition(5)


@pytest.mark.parametrize("k, rounds", [(5, 3), (1, 1), (12, 0), (500, 2)])
def test_clusters_match_plain_rounds(vectors, k, rounds):
    rows, table = vectors
    centers, want = plain_clusters(rows, k, rounds, 4)
    got_centers, got = centroids.cluster(table, k, rounds, components=4)
    assert [list(c) for c in got_centers] == centers
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_cluster_facts_add_up(vectors):
    centers, got = centroids.cluster(vectors[1], 6, 2, components=4)
    rows = centroids.with_cluster_facts(got, centers).collect()
    assert {r["inertia"] for r in rows} == {sum(r["distance"] for r in rows)}
    for r in rows:
        assert r["cluster_inertia"] == sum(o["distance"] for o in rows if o["cluster"] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centers[r["cluster"]])).encode()).hexdigest()


def test_no_vectors_give_no_clusters(vectors):
    centers, got = centroids.cluster(vectors[1].limit(0), components=4)
    assert centers == [] and centroids.with_cluster_facts(got, centers).collect() == []


# --- chats -------------------------------------------------------------------

HOSTILE = ["", "\\", "\\\\", "<|", "<|end|>", "<\\|turn|>", "x<", "|>", "\\<|", "<|turn|>user<|body|>\\", "é<|\U0001f600\n", "a" * 40000, None]


@pytest.fixture(scope="module")
def hostile_turns(spark):
    rng = random.Random(8)
    rows = [(i // 4, i % 4, rng.choice(["user", "assistant", "a<|b\\", "", None]), rng.choice(HOSTILE)) for i in range(200)]
    rows += [(100, 0, "assistant", t) for t in HOSTILE] + [(101, None, "user", "late"), (101, 5, "assistant", "early")]
    rows += [(102, 1, "assistant", "same")] * 3 + [(None, 0, "assistant", "no id")]
    return rows, spark.createDataFrame(
        [(*r, "clash", "clash", "clash") for r in rows],
        "conv_id bigint, turn bigint, role string, text string, body string, start string, place string",
    ).repartition(6)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_hostile_texts_come_back(hostile_turns):
    rows, table = hostile_turns
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(table)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, found in got.items():
        own = sorted(
            ((t is None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv),
            key=lambda x: (x[0], x[1], x[2].encode(), x[3].replace("\\", "\\\\").replace("<|", "<\\|").encode()),
        )
        assert found["n_turns"] == len(own)
        assert found["turns_sha256"] == digest("".join(f"{role}\n{text}\n" for _, _, role, text in own))
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        assert (found["loss_chars"], found["loss_sha256"]) == (len(loss), digest(loss))


def test_formatted_text_holds_only_its_own_marks(hostile_turns):
    for row in chat.format_chats(hostile_turns[1]).collect():
        assert row["formatted"].count(chat.TURN) == row["formatted"].count(chat.END) == row["n_turns"]
        raw = row["formatted"].encode()
        for span in row["turns"]:
            assert raw[span["start_byte"] - len(chat.BODY) : span["start_byte"]] == chat.BODY.encode()
            end = span["start_byte"] + span["bytes"]
            assert raw[end : end + len(chat.END)] == chat.END.encode()


def test_parts_are_visited_in_order(spark):
    part = lambda kind, **known: tuple(
        {"type": kind, **known}.get(c) for c in ("type", "text", "ref", "width", "height", "seconds", "pages")
    )
    rows = [
        (1, 0, "user", [part("text", text="see <|image|>"), part("image", ref="a.png", width=56, height=29), part("text", text=" and "),
                        part("audio", ref="b.wav", seconds=1.01)]),
        (1, 1, "assistant", [part("document", ref="c.pdf", pages=3), part("text", text="fine"), part("video", ref="d.mp4"), None]),
        (2, 0, "user", None), (2, 1, "assistant", []), (2, 2, "user", [part("image"), part(None, text="t"), part("audio", seconds=-1.0)]),
    ]
    table = spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, text {chat.PARTS}")
    got = {r["conv_id"]: r for r in chat.format_chats(table).collect()}
    assert got[1]["formatted"] == (
        "<|turn|>user<|body|>see <\\|image|><|image|> and <|audio|><|end|>"
        "<|turn|>assistant<|body|><|document|>fine<|attachment|><|end|>"
    )
    assert [tuple(a) for a in got[1]["attachments"]] == [
        (1, "image", "a.png", 4), (1, "audio", "b.wav", 26), (2, "document", "c.pdf", 1536), (2, "attachment", "d.mp4", 1),
    ]
    assert got[1]["expanded_tokens"] == 4 + 26 + 1536 + 1
    assert [tuple(a) for a in got[2]["attachments"]] == [(3, "image", "", 1), (3, "audio", "", 25)]
    assert got[2]["formatted"].endswith("<|image|>t<|audio|><|end|>")


def test_no_turns_give_no_chats(hostile_turns):
    assert chat.read_back(chat.format_chats(hostile_turns[1].limit(0))).collect() == []


def test_chats_use_no_python_on_the_data(hostile_turns):
    plan = chat.read_back(chat.format_chats(hostile_turns[1]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


# --- resampling --------------------------------------------------------------


def plain_draw(texts, target, run, buckets, per_cent, least):
    def features(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        runs = [" ".join(found[i : i + n]) for n in range(1, run + 1) for i in range(len(found) - n + 1)]
        return len(found), [zlib.crc32(r.encode()) % buckets for r in runs]

    docs = [(i, *features(t)) for i, t in texts]
    s, t = [0] * buckets, [0] * buckets
    for _, _, found in docs:
        for b in found:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, n, found in docs:
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append((i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    may = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    return out, may[: per_cent * len(may) // 100]


@pytest.mark.parametrize("run, per_cent, least", [(1, 10, 20), (2, 60, 1), (1, 100, 0), (1, 0, 20), (3, 33, 5)])
def test_draw_matches_a_sort(spark, docs, texts, run, per_cent, least):
    target = [(0, texts[0][1]), (1, None), (2, texts[30][1]), (3, "ONE two")]
    got = resampling.resample(
        docs, spark.createDataFrame(target, "item_id bigint, text string"), per_cent, least, run, buckets=97
    ).collect()
    every, chosen = plain_draw(texts, [t for _, t in target], run, 97, per_cent, least)
    known = lambda rows: sorted(((r[0], r[1], r[2], r[3]) for r in rows), key=str)
    assert known(got) == known([(i, n, w, s) for i, _, n, w, s in every])
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(chosen) + 1))
    assert [(r["doc_id"], r["score"]) for r in ranked] == [(i, s) for i, _, _, _, s in chosen]


def test_cutoff_among_repeated_rows(spark):
    rows = spark.range(0, 3000, 1, 7).select(
        F.lit(5).cast("bigint").alias("place"), F.when(F.col("id") < 10, -1).otherwise(3).cast("bigint").alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    for wanted in (0, 1, 10, 11, 1500, 2999, 3000, 4000):
        chosen = rows.where(resampling.drawn(rows, wanted))
        assert chosen.count() == min(wanted, 3000)
        assert chosen.where("tie = -1").count() == min(wanted, 10)


def test_least_reaching_is_a_search():
    for values in ([3], [1, 1, 1, 9], list(range(100)), [-(2**62), 0, 2**62]):
        for wanted in range(1, len(values) + 1):
            asked = []

            def count_upto(marks):
                asked.append(len(marks))
                return [sum(v <= m for v in values) for m in marks]

            assert resampling.least_reaching(count_upto, min(values), max(values), wanted) == sorted(values)[wanted - 1]
            assert len(asked) <= 17 and max(asked, default=0) < resampling.PARTS


def test_no_documents_and_no_target(spark, docs, no_docs):
    target = spark.createDataFrame([], "item_id bigint, text string")
    assert resampling.resample(no_docs, target).collect() == []
    assert resampling.resample(docs, target).count() == docs.count()
