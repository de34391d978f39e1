"""What the pipeline's tasks hold at once."""

import tracemalloc
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa

from conflux.llm import lang_mix, near_dedup, piece_offsets
from conflux.llm.common import slices


def test_short_texts_are_signed_a_few_at_a_time():
    batch = pa.record_batch({"text": [f"w{i} a b c d e f" for i in range(3000)], "at": range(3000)})
    registers = near_dedup.FINE[0] * near_dedup.FINE[1]
    parts = list(near_dedup.few_at_once([batch], registers))
    assert list(chain.from_iterable(p.column("at").to_pylist() for p in parts)) == list(range(3000))
    assert max(p.num_rows for p in parts) * registers <= near_dedup.SIGNATURES


def test_language_holds_trigrams_of_little_text():
    rng = np.random.default_rng(5)
    model = lang_mix.Mixture({x: rng.integers(0, 50, 1 << lang_mix.BITS) for x in "abcd"}, 3.0)
    texts = ["".join(map(chr, rng.integers(97, 123, 2000))) for _ in range(1000)]
    lang_mix.trigrams(["a word"])
    tracemalloc.start()
    for b in slices([pa.record_batch({"text": texts})], most=lang_mix.TEXT_BYTES):
        model.predict(b.column("text").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


def test_piece_model_remembers_little():
    assert piece_offsets.Model(public_tokenizers.path("piece_bpe_32k.model")).words.most <= 64 << 20
