"""Spelling variants by composing automata: the vocabulary's acceptor, a one-edit transducer, and the acceptor again.

States of the composition are pairs of acceptor states with the number of edits so far.  Before the edit both sides have read
the same prefix; after it they must read the same suffix.  The work is dealt by initial state, which is a prefix: all words below a
prefix of at most ``group_words`` words make a group, whose minimised acceptor is built and composed in one task.  Pairs that
are accepted come from a walk over the words; at each state the edit arcs that lead to a common suffix are found once,
with a memo over pairs of states.

A prefix with more words is not a group.  Its edit arcs (delete or replace the sign that follows the prefix) are taken by a
shuffle instead: the suffixes that both sides must share are the key, and as words of a key differ in one sign, a key never
holds more words than the alphabet and one.  So neither a common beginning nor a large vocabulary meets in one task.

Counting: runs of letters are cut, altered and counted by DataFrame functions; a word meets its count after map-side sums.

Defined cases: a null text has no words; a null ``doc_id`` counts as an empty one; repeated rows count each; ties of
``n`` go to the word that is smaller in code-point order; a run of any length is a word; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import Scratch

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5  # a form has so many times its word's occurrences at least
GROUP_WORDS = 20_000
NOISE = 199  # one in so many runs loses a sign
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- words ---------------------------------------------------------------------


def _lower_ascii(text: Column) -> Column:
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """``word, n`` of all words of at least ``min_chars`` code points and ``min_count`` occurrences."""
    # a maximal run of fewer letters holds no match, so the pattern's matches are whole runs
    runs = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{min_chars},}}"), F.lit(0))
    each = docs.select("doc_id", F.explode(runs).alias("run")).select("doc_id", _lower_ascii(F.col("run")).alias("run"))
    seed = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    hashed = each.select("run", F.crc32(F.encode(seed, "utf-8")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = hashed.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.char_length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


# --- automata ------------------------------------------------------------------


class Acceptor:
    """The minimised acceptor of sorted words; states are numbered from the ends to the root."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        open_arcs: list[dict[str, int]] = [{}]
        open_final = [False]
        before = ""
        for word in words:
            common = shared_prefix(before, word)
            self._close(open_arcs, open_final, before, common)
            open_arcs += [{} for _ in range(len(word) - common)]
            open_final += [False] * (len(word) - common)
            open_final[-1] = True
            before = word
        self._close(open_arcs, open_final, before, 0)
        self.root = self._state(open_arcs[0], open_final[0])

    def _close(self, open_arcs: list, open_final: list, word: str, depth: int) -> None:
        """States of ``word`` deeper than ``depth`` get no further arcs."""
        while len(open_arcs) > depth + 1:
            state = self._state(open_arcs.pop(), open_final.pop())
            open_arcs[-1][word[len(open_arcs) - 1]] = state

    def _state(self, arcs: dict[str, int], final: bool) -> int:
        key = (final, *arcs.items())  # sorted words give their arcs in order
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return self._known[key]

    def path(self, word: str) -> list[int]:
        out = [self.root]
        for sign in word:
            out.append(self.arcs[out[-1]][sign])
        return out


def shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class Composition:
    """The acceptor, one edit, and the acceptor again."""

    def __init__(self, acceptor: Acceptor):
        self.acceptor = acceptor
        self._meets: dict[tuple[int, int], bool] = {}
        self._edits: dict[int, list[tuple]] = {}

    def meets(self, p: int, q: int) -> bool:
        """Whether a suffix is accepted from both states; without recursion, as words may be long."""
        arcs, final, memo = self.acceptor.arcs, self.acceptor.final, self._meets
        start = (p, q) if p < q else (q, p)
        stack = [start]
        while stack:
            pair = stack[-1]
            if pair in memo:
                stack.pop()
                continue
            p, q = pair
            if p == q or (final[p] and final[q]):
                memo[pair] = True
                continue
            found, open_pair = False, None
            few, many = (arcs[p], arcs[q]) if len(arcs[p]) < len(arcs[q]) else (arcs[q], arcs[p])
            for sign, x in few.items():
                y = many.get(sign)
                if y is not None:
                    below = (x, y) if x < y else (y, x)
                    known = memo.get(below)
                    if known:
                        found = True
                        break
                    if known is None:
                        open_pair = below
            if found or open_pair is None:
                memo[pair] = found
            else:
                stack.append(open_pair)
        return memo[start]

    def edits(self, state: int) -> list[tuple]:
        """Edit arcs that lead to a common suffix: (sign left, state left, sign right, state right); '' reads no sign."""
        if state not in self._edits:
            arcs = list(self.acceptor.arcs[state].items())
            out = []
            for i, (a, p) in enumerate(arcs):
                if self.meets(p, state):
                    out.append((a, p, "", state))
                out += [(a, p, b, q) for b, q in arcs[:i] if self.meets(p, q)]
            self._edits[state] = out
        return self._edits[state]

    def suffixes(self, p: int, q: int):
        """All suffixes accepted from both states."""
        arcs, final = self.acceptor.arcs, self.acceptor.final
        stack, signs = [(p, q, 0, "")], []
        while stack:
            p, q, depth, sign = stack.pop()
            del signs[max(0, depth - 1) :]
            if depth:
                signs.append(sign)
            if final[p] and final[q]:
                yield "".join(signs)
            for sign, x in arcs[p].items():
                y = arcs[q].get(sign)
                if y is not None and self.meets(x, y):
                    stack.append((x, y, depth + 1, sign))

    def pairs(self, words: list[str], before: str = ""):
        """All pairs of sorted words one edit apart, once each; ``before`` is what all words follow.

        Of a run of equal signs only the first one is deleted: the others give the same pair.
        """
        last = None
        for word in words:
            path = self.acceptor.path(word)
            new = 0 if last is None else shared_prefix(last, word) + 1
            for depth in range(new, len(path)):
                for a, p, b, q in self.edits(path[depth]):
                    head = word[:depth]
                    if b == "" and (before + head)[-1:] == a:
                        continue
                    for suffix in self.suffixes(p, q):
                        yield head + a + suffix, head + b + suffix
            last = word


def near_in_group(key, table):
    """For each word of a group that has near words there: how many, and the best one."""
    start = key[0].as_py()
    rows = sorted(zip((w[len(start) :] for w in table.column("word").to_pylist()), table.column("n").to_pylist()))
    words, n = [w for w, _ in rows], dict(rows)
    count: dict[str, int] = {}
    best: dict[str, tuple] = {}
    for pair in Composition(Acceptor(words)).pairs(words, start):
        for word, other in (pair, pair[::-1]):
            count[word] = count.get(word, 0) + 1
            told = (-n[other], other)
            if word not in best or told < best[word]:
                best[word] = told
    found = list(count)
    return pa.table(
        {
            "word": pa.array([start + w for w in found], pa.string()),
            "n_near": pa.array([count[w] for w in found], pa.int64()),
            "minus_n": pa.array([best[w][0] for w in found], pa.int64()),
            "near": pa.array([start + best[w][1] for w in found], pa.string()),
        }
    )


# --- the whole vocabulary --------------------------------------------------------


def split_prefixes(vocabulary: DataFrame, scratch: Scratch, group_words: int) -> DataFrame:
    """Prefixes of more than ``group_words`` words; at each length at most one in ``group_words`` of the vocabulary."""
    out, length = None, 0
    while True:
        prefix = F.substring("word", 1, length)
        reached = vocabulary.filter(F.char_length("word") >= length).groupBy(prefix.alias("prefix")).agg(F.count("*").alias("words"))
        level = scratch.store(reached.filter(F.col("words") > group_words).select("prefix", F.lit(length).alias("length")), f"split-{length}")
        out = level if out is None else out.union(level)
        if level.isEmpty():
            return out
        length += 1


def _near_by_shuffle(levels: DataFrame) -> DataFrame:
    """Words whose edit is the first sign after a split prefix: they share prefix and suffix.

    A key's words are the word that is the key itself and words with one more sign at the same place.
    """
    at = F.col("length")
    cut = F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2))
    first = (at == 0) | (F.substr("word", at, F.lit(1)) != F.substr("word", at + 1, F.lit(1)))
    longer = levels.filter(F.char_length("word") > at).select("length", cut.alias("key"), "word", "n", F.lit(False).alias("whole"), first.alias("first"))
    whole = levels.select("length", F.col("word").alias("key"), "word", "n", F.lit(True).alias("whole"), F.lit(False).alias("first"))
    member = F.struct((-F.col("n")).alias("minus_n"), "word", "whole", "first")
    met = longer.union(whole).groupBy("length", "key").agg(F.sort_array(F.collect_list(member)).alias("all")).filter(F.size("all") > 1)
    each = met.select("all", F.explode("all").alias("me"))
    both_longer = lambda x: ~x["whole"] & ~F.col("me.whole")
    deleted = lambda x: (x["whole"] & F.col("me.first")) | (F.col("me.whole") & x["first"])
    others = F.filter("all", lambda x: (x["word"] != F.col("me.word")) & (both_longer(x) | deleted(x)))
    return (
        each.select("me.word", others.alias("others"))
        .filter(F.size("others") > 0)
        .select("word", F.size("others").cast("long").alias("n_near"), F.col("others")[0]["minus_n"].alias("minus_n"), F.col("others")[0]["word"].alias("near"))
    )


def near_words(vocabulary: DataFrame, scratch: Scratch, group_words: int = GROUP_WORDS) -> DataFrame:
    """``word, n_near, near, near_n`` of each word with near words; ``near`` has the largest ``n``."""
    split = split_prefixes(vocabulary, scratch, group_words)
    deepest = split.agg(F.coalesce(F.max("length"), F.lit(-1))).first()[0] + 1  # groups begin here at the latest
    # a word's split prefixes are all its prefixes up to some length, so their number is where its group begins
    upto = F.least(F.lit(deepest), F.char_length("word"))
    levels = vocabulary.select("word", "n", F.explode(F.sequence(F.lit(0), upto)).alias("length"))
    levels = levels.withColumn("prefix", F.expr("substring(word, 1, length)"))
    hot = split.withColumn("hot", F.lit(True))
    known = scratch.store(levels.join(hot, ["prefix", "length"], "left").select("word", "n", "prefix", "length", "hot"), "levels")
    local = known.filter("hot IS NULL").groupBy("word", "n").agg(F.min(F.struct("length", "prefix")).alias("group"))
    inside = local.select(F.col("group.prefix").alias("prefix"), "word", "n").groupBy("prefix")
    found = inside.applyInArrow(near_in_group, "word string, n_near long, minus_n long, near string")
    if deepest:
        found = found.union(_near_by_shuffle(known.filter("hot")))
    best = F.min(F.struct("minus_n", "near"))
    total = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return total.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus_n")).alias("near_n"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` of words with a form: where following forms ends.  Each round doubles the steps taken."""
    links, step = forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), 0
    links = scratch.store(links, "root-0")
    while not links.filter("moved").isEmpty():
        step += 1
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(ahead, "root", "left")
        moved = moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        links = scratch.store(moved, f"root-{step}")
    return links.select("word", "root")


def group_variants(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    group_words: int = GROUP_WORDS,
    noise: int = NOISE,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: each word with the far more frequent word that it is a variant of."""
    with Scratch(docs.sparkSession, "spelling") as scratch:
        vocabulary = scratch.store(count_words(docs, min_chars, min_count, noise), "vocabulary")
        near = near_words(vocabulary, scratch, group_words)
        joined = vocabulary.join(near, "word", "left")
        fits = F.col("near_n") >= ratio * F.col("n")
        formed = scratch.store(
            joined.select(
                "word",
                F.when(fits, F.col("near")).alias("form"),
                "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(fits, F.col("near_n")).alias("form_n"),
            ),
            "formed",
        )
        ends = roots(formed.filter(F.col("form").isNotNull()), scratch)
        out = formed.join(ends, "word", "left")
        return scratch.keep(out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
