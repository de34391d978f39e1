"""Blocks of a store are decoded once, and what is kept of units."""

import numpy as np
import public_tokenizers

from conflux.llm import token_store
from conflux.llm.units import UnitIds


def test_digests_decode_each_block_once(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i} " * 50) for i in range(20)], "doc_id long, text string")
    token_store.write_store(docs, f"{tmp_path}/store", public_tokenizers.path("byte_bpe_50k.json"))
    digests = token_store.read_digests(spark, f"{tmp_path}/store")
    assert "MapInArrow" not in digests._jdf.queryExecution().toString()      # what the two parts read is staged
    assert digests.count() == 20


def test_units_kept_together_are_bounded_and_right():
    units = UnitIds(lambda new: [[len(x), 7] * (len(x) % 3) for x in new], most_bytes=4000)
    rng = np.random.default_rng(3)
    for _ in range(30):
        asked = [b"x" * int(n) for n in rng.permutation(60)[:25]]
        units.find(asked)
        flat, n = units.gather(np.arange(len(asked)))
        assert flat.tolist() == [i for x in asked for i in [len(x), 7] * (len(x) % 3)]
        assert n.tolist() == [2 * (len(x) % 3) for x in asked]
        assert units.held_bytes() <= 4000
