"""What a Python worker holds of its batches and of other operators' stages."""

import pyarrow as pa
from tokenizers import Tokenizer

from tidegrain.llm import bpe, common
from tidegrain.llm.queries import BYTE_BPE, tokenizer


def test_few_texts_of_a_batch_at_a_time():
    texts = [f"Word{i} and another{i % 7} of the text, {i * 31} times" if i % 9 else None for i in range(1000)]
    col, taken = pa.array(texts), []

    class Watched:
        def __len__(self):
            return len(col)

        def slice(self, i, n):
            taken.append(i)
            return col.slice(i, n)

    stream = bpe.TrieBPE(tokenizer(BYTE_BPE), held=100).stream(bpe.texts_of(Watched()), room=2000)
    got = [next(stream)]
    assert len(taken) == 1
    lib = Tokenizer.from_file(tokenizer(BYTE_BPE))
    assert [*got, *stream] == [lib.encode(t or "", add_special_tokens=False).ids for t in texts] and len(taken) == 16


def test_memory_of_other_operators_goes_back_before_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "hand_back", lambda: calls.append(set(common.HELD)))
    monkeypatch.setattr(common, "HELD", {"other": {}, "bpe": {}})
    common.forget("bpe")
    common.forget("bpe")
    assert calls == [{"bpe"}]
