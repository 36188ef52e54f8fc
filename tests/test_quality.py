"""The seven checks and the gate."""

import pytest
from pyspark.sql import functions as F

from quillspark.functions import quality

T = F.col("t")


@pytest.mark.parametrize("n, ok", [(69, False), (70, True), (130, True), (131, False)])
def test_length_band(value, n, ok):
    assert value("g" * n, quality.length_valid(F.lit("o" * 100), T)) is ok


def test_length_floor(value):
    assert value("g" * 29, quality.length_valid(F.lit("o" * 29), T)) is False


def test_topic(value):
    original = F.lit("quantum lattice theory energy photon")
    assert value("quantum things", quality.topic_consistent(original, T, F.lit(""))) is True
    assert value("other things", quality.topic_consistent(original, T, F.lit("zebra"))) is False
    assert value("other zebra", quality.topic_consistent(original, T, F.lit("zebra"))) is True
    assert value("anything", quality.topic_consistent(F.lit("a b"), T, F.lit(""))) is True


@pytest.mark.parametrize(
    "t, ok",
    [("plain words", True), ("a --- b", False), ("HERE IS it", False), ("In Summary: x", False), ("## h", False)],
)
def test_leakage(value, t, ok):
    assert value(t, quality.no_prompt_leakage(T)) is ok


def test_repetition_edges(value):
    # four of five distinct is exactly 0.8: allowed; three of five is not
    assert value("a. b. c. d. a.", quality.no_repetition(T)) is True
    assert value("a. b. c. a. a.", quality.no_repetition(T)) is False
    assert value("one sentence only", quality.no_repetition(T)) is True
    # a pair twice in twenty words is exactly a tenth: allowed; three times is not
    filler = " ".join(f"w{i}" for i in range(16))
    assert value(f"x. y z {filler} y z", quality.no_repetition(T)) is True
    twice = "p q r p q s p q " + " ".join(f"w{i}" for i in range(11))
    assert value(f"u. {twice}", quality.no_repetition(T)) is False


@pytest.mark.parametrize(
    "t, ok",
    [
        ("neutral statement " * 10, True),
        ("we " + "word " * 19, True),
        ("we " + "word " * 18, False),
        ("awesome cool amazing great things happen here", False),
        ("as we know " + "word " * 40, False),
        ("lèwe mé word " * 5, True),
    ],
)
def test_style(value, t, ok):
    assert value(t, quality.scientific_style(T)) is ok


def test_gate(value):
    def checks(passed):
        return {c: F.lit(i < passed) for i, c in enumerate(quality.CHECKS)}

    assert value("", quality.quality_gate(checks(5))) is False
    assert value("", quality.quality_gate(checks(6))) is True
    strict = {c: F.lit(c in ("not_empty", "no_prompt_leakage")) for c in quality.CHECKS}
    assert value("", quality.quality_gate(strict, strict=True)) is True
    assert value("", quality.quality_gate(strict)) is False
