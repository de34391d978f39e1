"""Findings of round 3."""

import time
from datetime import date

import numpy as np
from pyspark.sql import functions as F

from conflux.sources import files as FS


def test_stageable_characters_are_those_of_windows_1252(spark):
    def fits(c):
        if 0x80 <= ord(c) < 0xa0:
            return False
        try:
            c.encode("windows-1252")
        except UnicodeEncodeError:
            return False
        return True

    chars = [chr(c) for c in [*range(0xd800), *range(0xe000, 0x10000), 0x10000, 0x1f600, 0x10ffff]]
    df = spark.createDataFrame([(i, "é" + c + "a") for i, c in enumerate(chars)], "id long, t string")
    fit, rest = FS.split_stageable(df, multi_line=True)
    assert sorted(r.id for r in fit.collect()) == [i for i, c in enumerate(chars) if fits(c)]
    assert rest.count() == len(chars) - fit.count()


def test_values_that_are_not_text_stay_stageable(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, True, date(2024, 1, 2), None)], "a int, b double, c boolean, d date, e string")
    fit, rest = FS.split_stageable(df)
    assert fit.count() == 1 and rest.count() == 0
    path = FS.stage_delimited(fit, str(tmp_path / "s"))
    assert FS.read_delimited_stage(spark, path, df.schema).collect() == df.collect()


def test_checking_a_text_costs_little_more_than_reading_it(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 40, 1, 1).select("id", F.expr("repeat('Grüße, plain text \n', 20000)").alias("t")).write.parquet(path)
    df = spark.read.parquet(path)

    def seconds(frame):
        took = []
        for _ in range(3):
            at = time.perf_counter()
            assert frame.count() == 40
            took.append(time.perf_counter() - at)
        return min(took)

    assert seconds(FS.split_stageable(df, multi_line=True)[0]) < 6 * seconds(df.where(~F.col("t").rlike("[\u0100-\uffff]"))) + 0.2


def test_words_share_ids_whatever_stands_behind_them():
    import public_tokenizers
    from conflux.llm.token_store import Encoder
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Encoder(path)
    text = "".join(f" zerbleon{mark}" for mark in ["", ",", ".", "***", ".\nzerbleon", "42", "?!"])
    flat, n = own.encode([text])
    assert flat.tolist() == own.tok.encode(text, add_special_tokens=False).ids and n.tolist() == [len(flat)]
    # the word with and without a space before it, four kinds of marks, a number, a line break
    assert len(own.units.new) == 8


def test_cut_units_have_the_librarys_ids():
    import random
    import public_tokenizers
    from conflux.llm.token_store import Encoder
    own = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert own.by_run
    rnd = random.Random(4)
    bits = ["the", "Ça", "ɏ", "ɐ", "ɑb", "×", "÷", "ÿ", "it's", "'s", "'", "''ll", "x1", "42", "٣", "²", "...", "<", "<|", "<|endoftext|>", "|>", "\n",
            "\n\n", "\r\n", "\t", "\0", "\x1c", "\x7f", "\x85", "\xa0", "　", "日本", "🙂", "é", "_", "~", "-", "(a)", "Ωm", "ǅ"]
    texts = ["".join(rnd.choice(bits) + rnd.choice(["", "", " "]) for _ in range(rnd.randint(0, 12))) for _ in range(20000)]
    texts += ["", " ", "  ", "\n", " \n", "\n ", " a", "a ", "a\n b", "a\n\n b", "a\n"]
    for k in range(0, len(texts), 700):
        flat, n = own.encode(texts[k:k + 700])
        at = n.cumsum() - n
        for t, a, m in zip(texts[k:k + 700], at, n, strict=True):
            assert flat[a:a + m].tolist() == own.tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_a_task_sends_no_more_rows_than_ranges(spark):
    """However many phrases are proposed; each is counted, by its language and words."""
    from conflux.llm import phrase_mining as PM
    from conflux.llm.bit_table import BitTable
    words = [f"w{i}" for i in range(30_000)]
    odd = 'a"\t\nb\u2028'
    df = spark.createDataFrame([(" ".join(words), odd), (" ".join(words[:20_000]), odd), ("w1, w1", None), ("", "no")],
                               "text string, lang string").coalesce(1)
    full = BitTable(7, np.full(2, -1).astype(np.uint64))         # everything counts as proposed
    assert PM._sent(df, 2, full, None, 10).count() <= 1024
    found, passes = PM.frequent_phrases(df, least=2, longest=2, sample_one_in=1)
    got = {(r.lang, r.phrase): r.n for r in found.collect()}
    assert len(got) == found.count()
    assert got == ({(odd, w): 2 for w in words[:20_000]} | {(odd, f"{a} {b}"): 2 for a, b in zip(words[:19_999], words[1:20_000])}
                   | {(odd, ""): 50_000, ("und", ""): 2, ("und", "w1"): 2, ("no", ""): 0})
