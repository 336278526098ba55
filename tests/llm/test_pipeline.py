"""The pipeline, stage by stage, against what each stage must keep and drop."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from riskbook.llm import common, quality_rules
from riskbook.llm.common import read_table, stored
from tests.llm.test_decontaminate import _expected as contaminated
from tests.llm.test_near_dedup import _expected as grouped


def test_stages_on_a_whole_table(spark, sf_dir, tmp_path):
    docs = read_table(spark, sf_dir, "documents")
    outputs = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, outputs[-1], sf_dir).write.parquet(str(tmp_path / name))
        outputs.append(spark.read.parquet(str(tmp_path / name)))
    raw, good, single, clean, mixed = ({r.doc_id: r.text for r in o.collect()} for o in outputs[:5])
    assert all(o.columns == docs.columns for o in outputs[1:5])
    kept = {r.doc_id for r in quality_rules.quality_verdicts(docs).filter("kept").collect()}
    assert set(good) == kept and all(raw[k] == t for k, t in good.items())
    groups = grouped(list(good.items()), corpus_pipeline.SHINGLE_WORDS)
    assert set(single) == {k for k, (_, _, stays) in groups.items() if stays}
    items = [tuple(r) for r in read_table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    assert set(clean) == {k for k, _, _, _, bad in contaminated(list(single.items()), items) if not bad}
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.VOCABULARY)), 0
    rows = sorted(outputs[5].collect(), key=lambda r: r.start)
    texts = {}
    for r in outputs[4].collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert [r.doc_id for r in rows] == sorted(k for k, v in texts.items() for _ in v)
    for key, found in texts.items():
        ids = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in found]
        expected = sorted((len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in ids)
        assert sorted((r.n_tokens, r.ids_crc32) for r in rows if r.doc_id == key) == expected
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    folders = len(common._FOLDERS)
    again = corpus_pipeline.run(spark, sf_dir)
    assert len(common._FOLDERS) <= folders + 2  # the last stage's input and its files
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_odd_rows_pass_through_every_stage(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, doc string"
    prose = " ".join(f"word{i} of the" for i in range(100))
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "a", 0, 1, "x"), (2, prose, "en", None, 9, 1, "x"), (2, prose, "en", None, 9, 1, "x")]
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, str(tmp_path)), name)
            assert docs.columns == table.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_a_stage_leaves_tables_of_others(spark, sf_dir, tmp_path):
    docs = read_table(spark, sf_dir, "documents").limit(50)
    other = stored(docs, "other")

    def keeps(spark, docs, sf_dir):
        return stored(docs, "kept")

    stage = getattr(corpus_pipeline, "staged", lambda f: f)(keeps)
    built = stage(spark, docs, sf_dir)
    stage(spark, docs, sf_dir).write.parquet(str(tmp_path / "a"))
    folders = set(common._FOLDERS)
    result = corpus_pipeline.quality(spark, spark.read.parquet(str(tmp_path / "a")), sf_dir)
    assert len(folders - set(common._FOLDERS)) == 1  # that of the stage it follows
    assert other.count() == built.count() == 50 and result.count() <= 50
