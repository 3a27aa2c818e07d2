"""The pipeline against a plain version of its stages on a small table."""

import hashlib

import corpus_pipeline
from test_operators import DOC, brute_components, brute_dedup, corpus  # noqa: F401
from tokenizers import Tokenizer

from tidegrain.llm import mix, quality
from tidegrain.llm.queries import BYTE_BPE, ORACLES, QUERIES, tokenizer


def test_run_equals_plain_stages(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    src.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    keep = {r["doc_id"] for r in quality.classify(src).where("kept").collect()}
    docs = sorted((r for r in src.collect() if r["doc_id"] in keep), key=lambda r: r["doc_id"])
    comp = brute_components([r["text"] for r in docs])
    docs = [r for i, r in enumerate(docs) if comp[i][1] == i or not comp[i][0]]
    out = brute_dedup([r["text"] for r in docs])
    texts = []
    seen = set()
    for r, (_, removed, sha) in zip(docs, out, strict=True):
        w = (r["text"] or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            if key in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(key)
        text = b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode() if removed else r["text"]
        assert hashlib.sha256(b" ".join(text.encode().split())).hexdigest() == sha
        texts.append((r["doc_id"], text, r["lang"], r["source"], len(text)))
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mix.taken(spark.createDataFrame(texts, DOC)).collect()}
    lib, want = Tokenizer.from_file(tokenizer(BYTE_BPE)), []
    for i, text, *_ in texts:
        size, n = taken[i]
        for part in [text] * (n // size) + ([" ".join(text.encode().split()[j].decode() for j in range(n % size))] if n % size else []) if size else []:
            ids = lib.encode(part, add_special_tokens=False).ids
            want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substring_dedup", "mix", "bpe"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11)) and set(ORACLES) <= set(QUERIES)


def test_odd_tables(spark, tmp_path):
    prose = "The first sentence has some plain words in it. Another one follows, with other words again. " * 3
    rows = [(1, prose, "en", "a", None), (1, prose, "en", "a", None), (None, prose + "Tail.", None, None, 3), (2, None, None, None, None), (3, "", "en", "b", 0), (4, "y" * 300_000, "en", "b", 1), (5, prose, "en", None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.selectExpr("*", "map('k', doc_id) as `a.b`", "1 as k", "'x' as sig", "2 as _late")
    df.write.parquet(str(tmp_path / "odd/documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    assert {r["doc_id"] for r in got} <= {1, None, 4, 5} and 1 in {r["doc_id"] for r in got} and all(r["n_tokens"] > 0 for r in got)
    df.where("false").write.parquet(str(tmp_path / "none/documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
