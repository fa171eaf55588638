"""Whole-word dictionary rewriting in one pass over the tokens.

The meaning is the sequential one: every rule in its order replaces its key, taken literally,
wherever no ASCII letter, digit or underscore stands next to it, in the output of the rules
before. A text is a row of words (runs of those characters) and separators, and a rule whose
key is one word acts on words alone. So consecutive such rules make one step: for each key
the chain of rules is followed once, when the dictionary is built, and a text is split, each
word looked up in a hash set and the few that are found replaced.

A key with separators inside ("g-mail") cannot be looked up word by word and is a step of its
own, a literal search that costs a scan unless it is found. It is moved behind later one-word
rules, so that these still make one step, where the order provably does not matter: both
values hold a word, and no word of either rule's key is in the other's key or value. Neither
rule can then make, break or span a match of the other. A rule that does not meet this, or
whose key begins or ends with a separator, stays where it is.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import chain

from pyspark.sql import Column, functions as F

WORD = "[A-Za-z0-9_]+"
_TOKEN = re.compile("[A-Za-z0-9_]+|[^A-Za-z0-9_]+")


def _words(s: str) -> set[str]:
    return set(re.findall(WORD, s))


def _followed(word: str, rules: list[tuple[str, str]], places: dict[str, list[int]]) -> str:
    """What becomes of ``word`` after all one-word ``rules``, in order."""
    text, at = word, 0
    while True:
        following = [places[w][i] for w in _words(text) if w in places and (i := bisect_left(places[w], at)) < len(places[w])]
        if not following:
            return text
        rule = min(following)
        key, value = rules[rule]
        text, at = "".join(value if t == key else t for t in _TOKEN.findall(text)), rule + 1


def steps(mapping) -> list[tuple[str, list[tuple[str, str]]]]:
    """The rules (a dictionary, or pairs in order) as steps: ``("words", resolved pairs)`` or
    ``("literal", pairs in order)``. Keys and values are lower-cased; empty keys and rules that
    change nothing are left out."""
    pairs = [(str(k).lower(), str(v).lower()) for k, v in (mapping.items() if hasattr(mapping, "items") else mapping)]
    out: list = []
    words: list[tuple[str, str]] = []
    later: list[tuple[str, str]] = []

    def close():
        if words:
            places: dict[str, list[int]] = {}
            for i, (k, _) in enumerate(words):
                places.setdefault(k, []).append(i)
            out.append(("words", [(k, _followed(k, words, places)) for k in places]))
        if later:
            out.append(("literal", list(later)))
        words.clear()
        later.clear()

    def independent(a, b):
        return all(_words(v) for _, v in (a, b)) and not (_words(a[0]) & (_words(b[0]) | _words(b[1])) or _words(a[1]) & _words(b[0]))

    for rule in pairs:
        key, value = rule
        if not key or key == value:
            continue
        if re.fullmatch(WORD, key):
            if not all(independent(s, rule) for s in later):
                close()
            words.append(rule)
        else:
            movable = re.match(WORD, key) and re.search(WORD + r"\Z", key) and _words(value)
            later.append(rule)
            if not movable:
                close()
    close()
    return out


def _literal(s: str) -> str:
    """``s`` as a pattern that matches it and nothing else."""
    return re.sub(r"([^A-Za-z0-9_\s])", r"\\\1", s)


def _rewritten_words(c: Column, pairs: list[tuple[str, str]]) -> Column:
    keys = [k for k, _ in pairs]
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in pairs))
    tokens = F.regexp_extract_all(c, F.lit(_TOKEN.pattern), F.lit(0))
    written = F.concat_ws("", F.transform(tokens, lambda t: F.when(t.isin(keys), table[t]).otherwise(t)))
    return F.when(F.exists(tokens, lambda t: t.isin(keys)), written).otherwise(c)


def rewrite_all(c: Column, mapping) -> Column:
    """``c`` after all rules of ``mapping``; NULL stays NULL, an empty dictionary changes nothing."""
    for kind, pairs in steps(mapping):
        if kind == "words":
            c = _rewritten_words(c, pairs)
        else:
            rules = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f"(?<![A-Za-z0-9_]){_literal(k)}(?![A-Za-z0-9_])").alias("p"),
                                       F.lit(re.sub(r"([\\$])", r"\\\1", v)).alias("r")) for k, v in pairs])
            c = F.aggregate(rules, c, lambda acc, x: F.when(F.contains(acc, x["k"]), F.regexp_replace(acc, x["p"], x["r"])).otherwise(acc))
    return c
