import os
import re
import shutil
import subprocess
import sys
import tempfile

import corpus_pipeline
from tarmac.llm import bpe, minhash, mixing, quality, toxicity
from tarmac.llm.common import read_table
from tests.conftest import ROOT
from tests.llm.odd import empty_docs, odd_docs
from tests.llm.test_minhash import classes

SF = "/root/testdata/sf0.01"


def test_stages_follow_the_contract(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "bpe"]
    docs = read_table(spark, SF, "documents")
    columns, kept = docs.columns, {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        out = os.path.join(tempfile.mkdtemp(prefix="tarmac-test-"), name)
        stage(spark, kept[list(kept)[-1]], SF).write.parquet(out)
        kept[name] = spark.read.parquet(out)
        if name != "bpe":
            assert kept[name].columns == columns
    labels = {r["doc_id"]: r for r in read_table(spark, SF, "labels").collect()}

    def ids(name):
        return [r["doc_id"] for r in kept[name].select("doc_id").collect()]

    start, good, clean, single = (ids(n) for n in ("start", "quality", "toxicity", "near_duplicates"))
    known = [i for i in start if i in labels]
    assert sum((i in set(good)) == (labels[i]["quality"] == 1) for i in known) >= 0.97 * len(known)
    known = [i for i in good if i in labels]
    assert sum((i in set(clean)) == (labels[i]["toxic"] == 0) for i in known) >= 0.9 * len(known)
    assert sum(i in set(clean) for i in known if labels[i]["toxic"] == 0) >= 0.97 * len(known) * 0.85
    want, _ = classes([(r["doc_id"], r["text"]) for r in kept["toxicity"].collect()], 5)
    assert sorted(single) == sorted(i for i, c in want.items() if i == c)
    mixed = ids("mixing")
    assert set(mixed) == set(single) and len(single) < len(mixed) <= 1.5 * len(single) + 20
    assert sorted(ids("bpe")) == sorted(mixed)


def test_run_is_the_stages_in_order(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "n_tokens", "ids"} <= set(got.columns) and 100 < got.count() <= 300


def test_odd_rows_and_empty_table(spark):
    for docs in (odd_docs(spark), empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, "/root/testdata/sf0.001")
            assert name == "bpe" or got.columns == docs.columns
            assert got.count() <= 2 * docs.count()


def test_library_imports_without_this_package():
    copy = tempfile.mkdtemp(prefix="tarmac-test-")
    shutil.copytree(os.path.join(ROOT, "tarmac"), os.path.join(copy, "tarmac"), ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    code = "import __spark_entry__ as e; print(any(k.startswith('op') or k == 'pipeline' for k in e.queries()), len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    assert out.stdout.split()[0] == "False" and int(out.stdout.split()[1]) > 50
    code = "import __spark_entry__ as e; print(sorted(k for k in e.queries() if k[:2] == 'op' and k[2].isdigit()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert out.stdout.count("'op") == 10 and "True" in out.stdout


def test_nothing_else_imports_this_package():
    for folder, _, names in os.walk(os.path.join(ROOT, "tarmac")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    assert not re.search(r"\bllm\b", f.read()), name
    assert all(m.__name__.startswith("tarmac.llm.") for m in (bpe, minhash, mixing, quality, toxicity))
