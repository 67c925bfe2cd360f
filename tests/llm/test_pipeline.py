import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as cp
from hardcourt.llm import cotraining, packing
from hardcourt.llm.runtime import stored
from tests.llm.fixtures import SF, docs
from tests.llm.test_counts_and_packing import check_packing
from tests.llm.test_duplicates import classes_by_force
from tests.llm.test_texts import base_by_force, hits_by_force


def redact_by_force(text):
    out, at = [], 0
    for s, e, k in sorted((int(s), int(e), ("email", "ip", "card", "phone").index(k)) for k, s, e in (x.split(":") for x in base_by_force(text))):
        if s >= at:
            out += [text[at:s], ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")[k]]
        at = max(at, e)
    return "".join(out) + text[at:]


def test_pipeline_by_force(spark):
    """The rows of run() against plain versions of the stages; the first stage's model is the operator's own."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in cotraining.scored(df, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.keep]
    of = classes_by_force(rows)
    rows = [(i, t) for i, t in rows if of[i] == i]
    rows = [(i, t) for i, t in rows if not hits_by_force(t, items)[4]]
    rows = [(i, redact_by_force(t)) for i, t in rows]
    tok = Tokenizer.from_file(packing.tokenizer_path())
    check_packing(cp.run(spark, SF).collect(), {i: np.array(tok.encode(t, add_special_tokens=False).ids + [0], "<u4") for i, t in rows})


def test_stages_of_odd_tables(spark):
    for rows in (None, []):
        df = docs(spark, clash="case") if rows is None else docs(spark, clash="case", rows=rows)
        for k, (_, stage) in enumerate(cp.STAGES):
            names = df.columns
            df = stage(spark, df, SF)
            if k < len(cp.STAGES) - 1:
                assert df.columns == names
                # a table with names that differ by case only can't be written; the stages work by place
                df = stored(df.toDF(*(f"c{j}" for j in range(len(names))))).toDF(*names)
        assert df.count() >= (rows is None)


def test_repeated_rows_leave_one(spark):
    kept = cp.keep_one_of_near_duplicates(spark, docs(spark), SF).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3, 5, 6, 7, 8, 9]
    assert cp.keep_one_of_near_duplicates(spark, docs(spark, rows=[]), SF).count() == 0
