"""The pipeline stage by stage against brute force, each on what the one before kept, and its registered query."""

import __spark_entry__ as contract
import brute_llm as brute
import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """The smallest documents, and rows that stages drop or must not stumble over."""
    path = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first()["text"]
    long = next(r for r in rows if r["text"] and len(r["text"]) > 3000)
    more = [
        (9001, None, "en", "src0", 0),
        (9002, "12345 67890", "en", None, 11),
        (9003, long["text"], "en", "src1", len(long["text"])),
        (9004, f"the and of {item} that for", None, "src1", 0),
        (9005, "Write to the one at a.b@mail.example.com or +1 (234) 567-8901 and the other 10.1.2.3.", "en", "src2", 0),
    ]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return path


def redacted(text):
    listed, at, out = brute.personal_data(text)[4], 0, []
    for kind, start, end in (x.split(":") for x in listed.split(",") if x):
        if int(start) >= at:
            out += [text[at : int(start)], f"[{kind.upper()}]"]
        at = max(at, int(end))
    return "".join(out) + text[at:]


def test_every_stage_equals_brute_force(spark, sf_dir):
    names = [name for name, _ in corpus_pipeline.STAGES]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        kept.append(docs.collect())
        assert name == names[-1] or docs.columns == columns
    first = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    texts = [{r["doc_id"]: r["text"] for r in rows} for rows in kept[:4]]
    assert texts[0] == {d: t for d, t in first.items() if t and any(c.isalpha() for c in t)}
    assert not {9001, 9002} & set(texts[0])

    groups = brute.near_duplicates(texts[0])
    assert texts[1] == {d: t for d, t in texts[0].items() if groups[d][1] == d}
    assert 9003 not in texts[1]

    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = brute.contamination(texts[1], items)
    assert texts[2] == {d: t for d, t in texts[1].items() if not found[d][4]}
    assert 9004 not in texts[2]

    assert texts[3] == {d: redacted(t) for d, t in texts[2].items()}
    assert texts[3][9005] == "Write to the one at [EMAIL] or [PHONE] and the other [IP]."
    assert all(r["n_chars"] == len(r["text"]) for r in kept[3] if r["text"] != texts[2][r["doc_id"]])

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in kept[4]}
    assert pieces == set(brute.pieces(texts[3].items(), tokenizer)) and len(pieces) == len(kept[4])


def test_near_duplicates_are_of_five_words_and_80_percent(spark, sf_dir):
    """Copies with words appended or a block replaced, on both sides of the threshold."""
    texts = {}
    for i, (more, block) in enumerate([(180, 0), (249, 0), (250, 0), (0, 80), (0, 106), (0, 108)]):
        whole = [f"p{i}w{j}" for j in range(1000)]
        changed = whole[:400] + [f"p{i}r{j}" for j in range(block)] + whole[400 + block :] + [f"p{i}m{j}" for j in range(more)]
        texts |= {2 * i: " ".join(whole), 2 * i + 1: " ".join(changed)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    groups = brute.near_duplicates(texts, 5, 80)
    got = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir).collect()}
    assert got == {d for d in texts if groups[d][1] == d} == {*range(0, 12, 2), 5, 11}


def test_an_empty_table_passes_every_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0


def test_registered_queries():
    names = contract.queries()
    assert all(sum(x.startswith(f"op{n}_") for x in names) == 1 for n in range(1, 11)) and "pipeline" in names
    assert not set(contract.oracle_sql()) - set(names)
