"""The pipeline on a small corpus, and the registry."""

import os
import subprocess
import sys
from pathlib import Path

import __spark_entry__
import pytest
import corpus_pipeline
from asofworks.llm.store import kept

from tests.llm.conftest import prose
from tests.llm.test_dedup import expected_components
from tests.llm.test_language import labelled


def test_stages_take_effect_in_order(spark, docs, tmp_path):
    _, labels, _ = labelled(spark)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    at = docs
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        at = kept(stage(spark, at, str(tmp_path)), "test")
        counts.append(at.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert at.columns == docs.columns
        if name == "minhash near-dedup":
            left = [(r.doc_id, r.text) for r in at.select("doc_id", "text").collect()]
            found, _ = expected_components(left)
            assert all(k == v for k, v in found.items())
    assert counts[0] >= counts[1] >= counts[2] > 0 and at.columns == ["doc_id", "ids", "n_tokens"]


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def through(spark, docs, folder):
    """docs through all stages, each written and read again."""
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        at = kept(stage(spark, at, str(folder)), "test")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert at.columns == docs.columns
    return at


def test_an_empty_table_goes_through(spark, no_docs, tmp_path):
    assert through(spark, no_docs, tmp_path).count() == 0


def test_null_empty_and_very_long_texts_go_through(spark, tmp_path):
    long_text = "\n".join(prose(k, 500).replace("\n", " ") for k in range(150))
    rows = [(1, None, None, None, None), (2, long_text, "en", "a", len(long_text)), (3, "", None, "a", 0), (None, "w" * 200_000, None, None, None), (4, long_text, "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.n_tokens for r in through(spark, docs, tmp_path).collect()}
    # the later copy loses all its lines; null and empty texts have no words, so the mix takes none of them but with their source
    assert got[2] > 75_000 and got[None] > 10 and 4 not in got and got.get(3, 0) == got.get(1, 0) == 0


#: Runs a task of the encoder or the classifier as a Python worker does, and prints the MB that stay once it has ended.
HOLDS = """
import random, re, sys
import pyarrow as pa
from asofworks.llm import pieces, quality

def held():
    return int(re.search(r"Pss_Anon: +(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

class Docs:
    def select(self, *names):
        return self
    def mapInArrow(self, each, schema):
        return each

draw = random.Random(3)
words = ["".join(draw.choices("abcdefghij", k=draw.randint(3, 9))) for _ in range(40000)]
column = pa.array([" ".join(draw.choices(words, k=20000)) for _ in range(32)])
rows = pa.record_batch([pa.array(range(32)), column], ["doc_id", "text"])
if sys.argv[1] == "encoder":
    each = pieces.encode(Docs())
else:
    Docs.schema, Docs.columns = None, ["doc_id", "text"]
    Docs.sparkSession = sparkContext = type("Context", (), {"broadcast": staticmethod(lambda x: type("Held", (), {"value": x}))})
    Docs.sparkSession.sparkContext = sparkContext
    quality.train = lambda docs, labels: quality.Network.start()
    each = quality.keep_good(Docs(), None)
del words, column
before = held()
most = made = 0
for batch in each(iter([rows])):
    most, made = max(most, batch.nbytes), made + 1
del batch
print(made, most, held() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="reads Linux's account of memory")
@pytest.mark.parametrize("step,limit", [("encoder", 50), ("classifier", 30)])
def test_a_worker_gives_back_what_a_task_took(step, limit):
    done = subprocess.run([sys.executable, "-c", HOLDS, step], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2], env={**os.environ, "OMP_NUM_THREADS": "1"})
    made, most, held = map(float, done.stdout.split())
    assert made > 1 and held < limit and (step == "encoder" or most < 2 << 20)


#: Trains on 2,000 texts as the driver does, and prints the MB that stay.
TRAINED = """
import random, re
import pyarrow as pa
from asofworks.llm import quality

def held():
    return int(re.search(r"Pss_Anon: +(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

class Any:
    def __getattr__(self, name):
        return lambda *a, **b: self
    __invert__ = __and__ = __le__ = lambda self, *a: self

draw = random.Random(3)
Any.toArrow = lambda self: pa.table({"text": ["".join(draw.choices("abcdefghij ", k=draw.randint(100, 8000))) for _ in range(2000)], "y": [k % 2 for k in range(2000)]})
quality.F, quality.held_out, quality.EPOCHS = Any(), Any, 1
before = held()
quality.train(Any(), Any())
print(held() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="reads Linux's account of memory")
def test_the_driver_gives_back_what_training_took():
    done = subprocess.run([sys.executable, "-c", TRAINED], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2], env={**os.environ, "OMP_NUM_THREADS": "1"})
    assert float(done.stdout) < 45
