"""Operators that take an Arrow batch at once: results text by text, and what they hold of a batch."""

import numpy as np
import pyarrow as pa

from reelstat.llm import langid, sentencepiece_codec
from reelstat.llm.queries import tokenizer_path


def test_ids_of_many_texts_decode_as_those_of_each():
    with open(tokenizer_path(), "rb") as f:
        v = sentencepiece_codec.Vocabulary(f.read())
    control = sorted(v.control)
    lists = [[], v.encode("two words"), v.encode("  spaces ▁ and żółw 🐢"), [v.byte_ids[0xFF], v.byte_ids[0xE2]], control,
             [*control[:1], *v.encode("after")], [], v.encode("x"), [v.byte_ids[0x20], *v.encode("y")], [0], []]
    for chosen in (lists, [x for x in lists if v.control.isdisjoint(x)], [[], []]):
        flat = np.array([i for ids in chosen for i in ids], np.int32)
        ends = np.cumsum([len(ids) for ids in chosen]).tolist()
        assert v.decode_all(flat, ends) == [v.decode(ids) for ids in chosen]


def test_language_judges_hold_a_few_texts_of_a_batch(monkeypatch):
    samples = {"x": ["abra cadabra " * 20, "cab bad dab"] * 6, "y": ["lorem ipsum dolor " * 15, "sum more"] * 6}
    models = langid.fit(samples)
    texts = ["abracadabra " * 30, None, "lorem ipsum", "123", "", "dolor sum " * 50] * 40
    whole = models.judge([langid.characters(t or "") for t in texts])
    held, judge = [], langid.Models.judge
    monkeypatch.setattr(langid, "BATCH_CHARS", 2_000)
    monkeypatch.setattr(langid.Models, "judge", lambda self, part: held.append(sum(map(len, part))) or judge(self, part))
    parts = models.judge_all(pa.array(texts, pa.string()))
    assert max(held) < 2_600 and len(held) > 10
    assert all(np.array_equal(a, b) for a, b in zip(whole[:1] + whole[3:], parts[:1] + parts[3:]))
    assert np.allclose(whole[1], parts[1]) and np.allclose(whole[2], parts[2], equal_nan=True)
    assert [len(x) for x in models.judge_all(pa.array([], pa.string()))] == [0, 0, 0, 0]
