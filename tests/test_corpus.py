import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from orderlens.operators import corpus


def chunks(spark, text, key="doc"):
    frame = spark.createDataFrame([(key, text)], "k string, text string")
    return corpus.chunk_documents(frame, "k").orderBy("chunk_no").collect()


def test_four_stages(spark):
    text = "\n\n".join(["a" * 40, "b" * 480, "c" * 1300, "d" * 30])
    found = chunks(spark, text)
    assert [len(r["content"]) for r in found] == [40, 480, 500, 500, 332]
    assert found[-1]["content"] == "c" * 300 + "\n\n" + "d" * 30


def test_edges(spark):
    assert [len(r["content"]) for r in chunks(spark, "\n\n".join(["x" * 250, "y" * 248]))] == [500]
    assert [len(r["content"]) for r in chunks(spark, "\n\n".join(["x" * 250, "y" * 249]))] == [250, 249]
    assert [len(r["content"]) for r in chunks(spark, "z" * 550)] == [550]
    assert [len(r["content"]) for r in chunks(spark, "z" * 551)] == [500 + 2 + 51 if 500 + 2 + 51 <= 550 else 500, 51]
    assert [len(r["content"]) for r in chunks(spark, "z" * 545)] == [545]
    assert chunks(spark, "") == [] and chunks(spark, " \n\n\t\n ") == []
    assert [r["content"] for r in chunks(spark, "  one \n  \n two\nlines ")] == ["one\n\ntwo\nlines"]


def test_titles_and_sections(spark):
    text = "intro\n\n# Big Title \n\n" + "p" * 490 + "\n\n## First\n\n" + "q" * 490 + "\n\n## Second\n\n" + "r" * 490
    found = chunks(spark, text)
    assert {r["title"] for r in found} == {"Big Title"}
    sections = {r["content"][0]: r["section"] for r in found if len(r["content"]) > 400}
    assert sections["r"] == "Second" and found[0]["section"] == ""
    assert found[0]["label"] == "Big Title" and found[-1]["label"] == "Big Title › Second"
    assert chunks(spark, "## only a section\n\nbody", "stem")[0]["title"] == "stem"
    assert chunks(spark, "#no space\n\nbody", "stem")[0]["title"] == "stem"


def expected_chunks(text):
    """The rules, applied one after another to plain lists."""
    paragraphs, at = [], 0
    for part in corpus_split(text):
        body = part.strip()
        if body:
            paragraphs.append((body, at))
        at += len(body) + 2
    groups = []
    for body, position in paragraphs:
        if groups and len(groups[-1][0]) + 2 + len(body) <= 500:
            groups[-1] = (groups[-1][0] + "\n\n" + body, groups[-1][1])
        else:
            groups.append((body, position))
    pieces = [body[i:i + 500] if len(body) > 550 else body for body, _ in groups
              for i in (range(0, len(body), 500) if len(body) > 550 else [0])]
    result = []
    for piece in pieces:
        if result and len(piece) < 80 and len(result[-1]) + 2 + len(piece) <= 550:
            result[-1] += "\n\n" + piece
        else:
            result.append(piece)
    return result


def corpus_split(text):
    import re
    return re.split(r"\n\s*\n", text)


PARAGRAPH = st.tuples(st.sampled_from([0, 1, 20, 79, 80, 200, 249, 400, 499, 500, 501, 550, 551, 1100]),
                      st.sampled_from("aé漢😀"), st.sampled_from(["\n\n", "\n \n", "\n\n\n", "\n"]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PARAGRAPH, max_size=12), min_size=1, max_size=10))
def test_equals_the_rules(spark, documents):
    texts = ["".join(c * n + gap for n, c, gap in doc) for doc in documents]
    frame = spark.createDataFrame(list(enumerate(texts)), "k bigint, text string")
    found = {}
    for r in corpus.chunk_documents(frame, "k").orderBy("k", "chunk_no").collect():
        found.setdefault(r["k"], []).append(r["content"])
    assert found == {i: e for i, t in enumerate(texts) if (e := expected_chunks(t))}


def test_whole_long_document(spark):
    """Half a million characters in one document: nothing is cut off."""
    rng = random.Random(7)
    text = "\n\n".join("w" * rng.randint(1, 700) for _ in range(1500))
    found = [r["content"] for r in chunks(spark, text)]
    assert found == expected_chunks(text)


def test_corpus_ids_follow_document_and_chunk_order(spark):
    frame = spark.createDataFrame([(f"{i:03d}", "x" * 300 + "\n\n" + "y" * 300 * (i % 3)) for i in range(50)] + [("999", "")],
                                  "k string, text string").repartition(5)
    built = corpus.build_corpus(frame, "k", parts=4)
    ordered = [(r["k"], r["chunk_no"]) for r in built.orderBy("chunk_id").collect()]
    assert ordered == sorted(ordered) and sorted(r[0] for r in rows(built.select("chunk_id"))) == list(range(len(ordered)))


@pytest.mark.parametrize("position, section", [(0, ""), (6, "A"), (5, ""), (13, "A"), (14, "B"), (99, "B")])
def test_section_is_the_nearest_head_before(spark, position, section):
    frame = spark.createDataFrame([("intro\n## A\r\nx\n## B ",)], "t string")
    found = frame.select(corpus.section_heads(F.col("t")).alias("h"), F.lit(position).alias("p")).select(
        corpus.section_at(F.col("h"), F.col("p"))).first()[0]
    heads = [("A", 6), ("B", 14)]
    assert found == section == next((t for t, at in reversed(heads) if at <= position), "")


def test_work_grows_with_the_text():
    """Twice the paragraphs take about twice the time, also in one document."""
    def seconds(paragraphs):
        text = "\n\n".join(f"## part {i}\n\n" + "w" * (i % 600) for i in range(paragraphs))
        best = 9e9
        for _ in range(3):
            start = time.perf_counter()
            n = sum(1 for _ in corpus._sectioned(text))
            best = min(best, time.perf_counter() - start)
        assert n > paragraphs / 4
        return best

    assert seconds(50_000) < 3 * seconds(25_000)


def test_one_document_of_many_paragraphs(spark):
    text = "\n\n".join("p" * (i % 90) for i in range(50_000))
    assert [r["content"] for r in chunks(spark, text)] == expected_chunks(text)


def test_odd_documents(spark):
    """No text, no chunk; a null key stays a key; white space and line ends as Unicode has them."""
    frame = spark.createDataFrame([(None, "a\u2028## B\n\u3000\nbody", "t"), (1, None, "u"), (2, "", None)],
                                  "k int, text string, title string")
    found = [(r["k"], r["section"], r["content"], r["label"]) for r in corpus.chunk_documents(frame, "k", "text", "title").collect()]
    assert found == [(None, "", "a\u2028## B\n\nbody", "t")]
