"""The pipeline: each stage against what its operator decides on the stage's own input."""

import os

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from murmura.llm import decontaminate, minhash, pii, quality
from murmura.llm.common import settle, table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_stages_decide_as_their_operators_do(spark):
    docs = table(spark, SF_DIR, "documents")
    labels, bench = table(spark, SF_DIR, "labels"), table(spark, SF_DIR, "benchmark")
    columns, before = docs.columns, docs
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        after = settle(stage(spark, before, SF_DIR), "test-stage")
        outs.append(after)
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert after.columns == columns, name
            before = after

    def ids(df):
        return {r.doc_id for r in df.select("doc_id").collect()}

    good, single, clean, private, encoded = outs
    scores = quality.score_quality(docs, labels)
    assert ids(good) == ids(scores.where("predicted = 1"))
    assert ids(single) == ids(minhash.near_duplicates(good).where("kept"))
    assert ids(clean) == ids(single) - ids(decontaminate.contaminated(single, bench))
    assert ids(private) == ids(clean)
    found = {r.doc_id: r for r in pii.find_personal_data(clean).collect()}
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in private.collect():
        assert (r.text == texts[r.doc_id]) == (found[r.doc_id].spans == "")
        assert r.n_chars == len(r.text) or r.text == texts[r.doc_id]
    assert pii.find_personal_data(private).where("n_email + n_card + n_phone > 0").count() == 0
    assert ids(encoded) == ids(private) and encoded.where("not lossless").count() == 0
    assert sorted(map(str, corpus_pipeline.run(spark, SF_DIR).collect())) == sorted(map(str, encoded.collect()))


def test_every_operator_is_registered_once():
    names = [n for n in entry_point.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry_point.queries()


def test_functions_travel_without_the_package(tmp_path):
    """What tasks get can be opened where this repository is not on the path."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from murmura.llm import html_text, pieces, toxicity

    field = toxicity.Field({b"w:bad": 1.0})
    parts = [html_text.extract, pieces.Codec, lambda: field.emissions([b"bad"], {}).tolist()]
    (tmp_path / "parts").write_bytes(cloudpickle.dumps(parts))
    code = "import pickle; a, b, c = pickle.load(open('parts', 'rb')); print(a('<p>x</p>'), b.__name__, c())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert said.stdout == "x Codec [[1.0, 0.0, 0.0, 0.0]]\n", said.stderr
