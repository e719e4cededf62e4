"""The pipeline's stages where ids are null or repeated: each row is judged by itself."""

import sys
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from twinfold.llm import language  # noqa: E402
from twinfold.llm.common import held  # noqa: E402

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)
A = "a text of its own with more than a few words that nobody else has written down"
B = "quite another tale about rivers and hills and a long road to some distant town"
C = "numbers and tables fill this third page from the first line to the very last one"


@pytest.fixture(scope="module")
def frame(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema

    def of(rows):
        return spark.createDataFrame([(i, t, "en", "src1", 9) for i, t in rows], schema).repartition(3)

    return of


def rows(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_exact_stage_keeps_one_row_of_each_text(spark, frame):
    given = [(None, A)] * 5 + [(None, B), (1, B), (2, B), (2, B), (2, C), (3, A.upper() + "x")] + [(None, None), (None, "")]
    out = rows(STAGE["exact_dedup"](spark, frame(given), SF))
    empty = [n for (i, t), n in out.items() if not t]
    assert empty == [1]
    del out[None, None], out[None, ""]
    assert out == Counter([(None, A), (2, B), (2, C), (3, A.upper() + "x")])


def test_near_copy_stage_keeps_one_row_of_each_group(spark, frame):
    given = [(None, A), (None, A), (None, A.upper()), (None, B), (7, B), (7, B), (8, B), (7, C)]
    out = rows(STAGE["simhash"](spark, frame(given), SF))
    ours = [k for k in out if k[1] in (A, A.upper())]
    assert len(ours) == 1 and set(out.values()) == {1}
    assert set(out) - set(ours) == {(7, B), (7, C)}


def test_contaminated_rows_go_whatever_their_id(spark, frame):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 100").first()["text"]
    given = [(None, A), (None, item), (5, item), (5, B), (5, B)]
    out = rows(STAGE["decontamination"](spark, frame(given), SF))
    assert out == Counter([(None, A), (5, B), (5, B)])


def test_language_stage_keeps_evenly_mixed_texts(spark):
    from pyspark.sql import functions as F
    from test_many_languages import texts

    langs = [f"l{k}" for k in range(8)]
    given = [(10 * k + j, t, x) for k, x in enumerate(langs) for j, t in enumerate(texts(x, 6))]
    mixed = " ".join(" ".join(texts(x, 1)[0].split()[:8]) for x in langs)
    ddl = "doc_id long, text string, lang string"
    docs = spark.createDataFrame([*given, (1000, mixed, None), (1001, "12 ...", None), (None, None, None)], ddl)
    out = rows(STAGE["language_id"](spark, docs, SF))
    assert out == Counter([*((i, t) for i, t, _ in given), (1000, mixed)])
    unknown = docs.withColumn("lang", F.lit(None).cast("string"))
    assert rows(STAGE["language_id"](spark, unknown, SF)) == rows(docs)


# Names that the stages and their operators use for columns of their own.
INNER = (
    "row_key gone_key kept_key Kept_Key_ group stays n digest keep_id group_size kept text_sha256 doc root "
    "component_id fingerprint vertex a b shard tile words shingle contaminated n_hit hits piece start length "
    "ids_crc32 sequence_id offset pack_part pack_rank lang_pred score draw share hint item_id"
).split()


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_columns_of_any_name(spark, stage):
    letters = [A, A, B, B.upper(), C, C, None, "12 34"]
    given = [(i // 2, t, "en", *INNER) for i, t in enumerate(letters)]
    ddl = "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in INNER)
    docs = spark.createDataFrame(given, ddl)
    found = STAGE[stage](spark, docs, SF)
    plain = rows(STAGE[stage](spark, docs.select("doc_id", "text", "lang"), SF)) if stage != "packing" else None
    if stage == "packing":
        assert found.count() == len(given)
    else:
        assert found.columns == docs.columns and rows(found) == plain
        assert {tuple(r)[3:] for r in found.collect()} == {tuple(INNER)}


def test_language_stage_fills_in_languages(spark):
    from test_many_languages import texts

    given = [(10 * k + j, t, x if j else None) for k, x in enumerate(["l1", "l2"]) for j, t in enumerate(texts(x, 30))]
    ddl = "doc_id long, text string, lang string"
    out = STAGE["language_id"](spark, spark.createDataFrame([*given, (500, "!", "l1")], ddl), SF).collect()
    assert {r["doc_id"]: r["lang"] for r in out} == {10 * k + j: x for k, x in enumerate(["l1", "l2"]) for j in range(30)}


def test_one_owner_holds_at_a_time():
    first = held("one", 1, list)
    assert held("one", 1, list) is first and held("one", 2, list) is not first
    held("two", 1, list)
    assert held("one", 1, list) is not first


def test_a_worker_gives_back_what_an_operator_held():
    def resident():
        return int(Path("/proc/self/statm").read_text().split()[1]) * 4096

    held("first", 1, lambda: [bytearray(1000) for _ in range(100_000)])
    pinned = bytearray(1000)  # lies behind them
    before = resident()
    held("second", 1, list)
    assert len(pinned) == 1000 and before - resident() > 50_000_000


def test_texts_of_a_batch_are_judged_some_at_a_time(monkeypatch):
    monkeypatch.setattr(language, "PORTION_CHARS", 10)
    texts = ["abcd", None, "efg", "hijk", "x" * 30, "", "y"]
    batch = pa.RecordBatch.from_pydict({"n": list(range(7)), "text": pa.array(texts, pa.string())})
    parts = [part.column("text").to_pylist() for part in language._slices(batch, 1)]
    assert parts == [["abcd", None, "efg"], ["hijk"], ["x" * 30], ["", "y"]]
    assert [*language._slices(batch.slice(0, 0), 1)] == []
