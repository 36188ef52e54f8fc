"""Prompts for counterpart texts, and rule-made counterparts for trial runs."""

from __future__ import annotations

from functools import partial
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.hashing import chance, draw
from quillspark.functions.quality import length_bounds
from quillspark.functions.text import let, words
from quillspark.functions.tokens import prompt_keywords


def length_targets(length: Column) -> dict[str, Column]:
    low, high = length_bounds(length)
    return {
        "min_length": low,
        "max_length": high,
        "target_words": F.floor(high / fv.CHARS_PER_WORD).cast("bigint"),
        "max_tokens": F.least(F.floor(length * fv.TOKENS_PER_CHAR), F.lit(fv.MAX_TOKENS)).cast("bigint"),
    }


def template_name(row_id: Column, seed: int = 42) -> Column:
    names = list(fv.PROMPT_TEMPLATES)
    pick = draw(seed, row_id, "template") % len(names)
    return F.element_at(F.array(*map(F.lit, names)), (pick + 1).cast("int"))


def build_prompt(template: Column, title: Column, text: Column, categories: Column) -> Column:
    """Fill the chosen template; the wording is split at its slots once, on the driver."""
    targets = length_targets(F.length(text))
    terms = F.array_join(prompt_keywords(text, 8), ", ")
    slots = {
        "title": title,
        "text": text,
        "categories": F.when(F.size(categories) > 0, F.array_join(categories, ", ")).otherwise(
            F.lit(fv.DEFAULT_CATEGORY)
        ),
        "keywords": F.when(terms == "", F.lit(fv.DEFAULT_KEYWORDS)).otherwise(terms),
        "min_length": targets["min_length"].cast("string"),
        "max_length": targets["max_length"].cast("string"),
        "target_length": targets["target_words"].cast("string"),
    }
    prompt = F.lit(None).cast("string")
    for name, wording in fv.PROMPT_TEMPLATES.items():
        parts = []
        for literal, slot, _, _ in Formatter().parse(wording):
            parts.append(F.lit(literal))
            if slot:
                parts.append(slots[slot])
        prompt = F.when(template == name, F.concat(*parts)).otherwise(prompt)
    return prompt


def length_ratio(generated: Column, original: Column) -> Column:
    ratio = F.try_divide(F.length(generated).cast("double"), F.length(original).cast("double"))
    return F.coalesce(F.rint(ratio * 100) / 100, F.lit(0.0))


def _apply_groups(text: Column, row_id: Column, groups: tuple, most: int, seed: int) -> Column:
    """Apply between two and ``most`` of the groups, in list order."""
    draws = F.array(*[draw(seed, row_id, f"group{g}") * 16 + g for g in range(len(groups))])
    wanted = (2 + draw(seed, row_id, "how_many") % (most - 1)).cast("int")
    chosen = let(
        draws,
        lambda d: let(
            F.element_at(F.sort_array(d), wanted), lambda last: F.transform(d, lambda x: x <= last)
        ),
    )

    def apply(group: tuple, flag: Column, t: Column) -> Column:
        changed = t
        for old, new in group:
            changed = F.replace(changed, F.lit(old), F.lit(new))
        return F.when(flag, changed).otherwise(t)

    def apply_all(flags: Column) -> Column:
        out = text
        for g, group in enumerate(groups):
            out = let(out, partial(apply, group, F.get(flags, F.lit(g))))
        return out

    return let(chosen, apply_all)


def synthetic_rewrite_basic(text: Column, row_id: Column, seed: int = 42) -> Column:
    return _apply_groups(text, row_id, fv.BASIC_REWRITES, 3, seed)


def synthetic_rewrite_full(text: Column, row_id: Column, seed: int = 42) -> Column:
    """Word swaps, now and then two sentences exchanged or the tail cut off."""
    changed = _apply_groups(text, row_id, fv.FULL_REWRITES, 4, seed)

    def exchange(s: Column) -> Column:
        at = (draw(seed, row_id, "swap_at") % (F.size(s) - 1)).cast("int")
        return F.transform(
            s,
            lambda piece, i: F.when(i == at, F.get(s, i + 1))
            .when(i == at + 1, F.get(s, i - 1))
            .otherwise(piece),
        )

    swapped = let(
        F.split(changed, r"\. "),
        lambda s: F.array_join(
            F.when(
                (F.size(s) > 2) & chance(seed, row_id, "swap", fv.SWAP_SHARE), exchange(s)
            ).otherwise(s),
            ". ",
        ),
    )
    def shorten(w: Column) -> Column:
        kept = F.greatest(F.size(w) - 10, F.floor(F.size(w) * F.lit(0.9)).cast("int"))
        return F.concat(F.array_join(F.slice(w, F.lit(1), kept), " "), F.lit("..."))

    return let(
        swapped,
        lambda t: F.when(
            chance(seed, row_id, "cut", fv.TRUNCATE_SHARE), let(words(t), shorten)
        ).otherwise(t),
    )


def mixed_document(human: Column, generated: Column) -> Column:
    """The first half of one text's sentences, then the second half of another's."""
    return let(
        F.struct(F.split(human, r"\. ").alias("h"), F.split(generated, r"\. ").alias("g")),
        lambda s: F.array_join(
            F.concat(
                F.slice(s["h"], F.lit(1), F.ceil(F.size(s["h"]) / 2).cast("int")),
                F.slice(
                    s["g"],
                    (F.floor(F.size(s["g"]) / 2) + 1).cast("int"),
                    F.ceil(F.size(s["g"]) / 2).cast("int"),
                ),
            ),
            ". ",
        ),
    )
