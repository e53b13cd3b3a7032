import pickle
import subprocess
import sys

import pyarrow as pa
from pyspark import cloudpickle

from cohortloom.llm import common, simhash


def test_functions_travel_without_the_library(tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(simhash._fingerprints))
    code = "import pickle; print(int(pickle.load(open('f', 'rb'))([b'a b c d'])[0]))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={}, capture_output=True, text=True, check=True)
    assert int(out.stdout) == int(simhash._fingerprints([b"a b c d"])[0])
    assert pickle.loads(cloudpickle.dumps(simhash._fingerprints))([b""])[0] == 0


def test_steps_are_bounded(monkeypatch):
    monkeypatch.setattr(common, "STEP_BYTES", 10)
    texts = ["a" * 4, None, "b" * 7, "c" * 50, "", "d"]
    batch = pa.RecordBatch.from_pydict({"key": list(range(6)), "text": texts})
    parts = list(common.steps([batch]))
    assert [k for p in parts for k in p.column(0).to_pylist()] == list(range(6))
    assert [len(p) for p in parts] == [2, 1, 1, 2]
    assert [t for p in parts for t in common.texts_of(p)] == [(t or "").encode() for t in texts]
