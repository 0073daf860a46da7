"""How much likelier a token is as words, names and numbers than as symbols drawn uniformly.

The model of words is a Markov chain, fitted to the corpus: to all its tokens of `SHORTEST` to `LONGEST`
characters, too short to be tested, which are words, names and numbers for the most part. Its classes
(lower case, upper case, digit, other) follow each other, and a letter the letter before it, as in these;
a word starts after a digit, a sign or at a capital. Digits and signs are uniform. Every alphabet has a
chain of its own, over its symbols only. So that a small corpus has one, too, the counts begin with those
of a list of common words and with usual steps between classes.

For tokens the chain makes, the chance that the uniform likelihood exceeds the chain's c times is at
most 1 / c (Markov's inequality), whatever their length: the ratio is a p-value without approximation.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import exact_text

#: Characters of the tokens that the chains are fitted to.
SHORTEST, LONGEST = 10, 19
SHORT_TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{SHORTEST},{LONGEST}}}+(?![A-Za-z0-9+/_=-])"

#: Common words of Latin-script languages and of programs; umlauts and accents as they're written in ASCII.
WORDS = """
the and that have with this from they which would there their about other after first these people could because through between
should before number system general information government development international different something understand question
connection application process service request response function object value string error message file name path type class index
return default update create delete config account password customer order item list table column key data time date length parent
child element content context handler manager factory builder provider exception abstract interface implementation resource property
configuration management environment authentication transaction communication performance available following without against
und der die das nicht ein eine mit auch sich dem den auf werden durch zwischen gesellschaft wirtschaft entwicklung verschiedene
moeglichkeit arbeit schule freundschaft geschichte bedeutung regierung unternehmen verstehen sprechen schreiben gleichzeitig
keiten heiten schaften lichkeit versicherung zusammen ausgabe einfach zurueck
les des une dans pour avec sur est sont nous vous leur mais comme plus autre entre toujours pendant developpement gouvernement
entreprise connaissance beaucoup maintenant quelque chose travail monde vouloir pouvoir eaux ement tionne aille euse
que los las para con una por como pero sobre entre cuando porque tambien nosotros trabajo ciudad gobierno desarrollo siempre
informacion universidad mientras mucho hacer tiene puede nuestro
che non per sono della nella questo quello anche essere fare dove quando perche lavoro citta sempre tutti
het van een niet zijn voor maar ook naar door worden onder tussen maatschappij werkelijk
nao uma mais para seu como foi ser quando muito tambem
""".split()

CLASSES = "ludo"
#: Usual chances of the next symbol's class (lower, upper, digit, other) after one of the first; "" is the
#: token's start. They weigh as much as `PRIOR` steps of the corpus from each class.
STEPS = {"": (0.45, 0.35, 0.15, 0.05), "l": (0.80, 0.08, 0.04, 0.08), "u": (0.45, 0.45, 0.04, 0.06), "d": (0.08, 0.05, 0.75, 0.12), "o": (0.5, 0.2, 0.2, 0.1)}
PRIOR = 1000
#: No chance of a class after another falls below this: rare styles of names stay possible.
LEAST_STEP = 0.05


def pairs_of_short_tokens(docs: DataFrame, text: str) -> dict[tuple[str, str], int]:
    """How often a character follows another ("" before the first) in the short tokens of all texts. At
    most a row for each pair of the encodings' characters reaches the driver."""
    tokens = F.regexp_extract_all(exact_text(text), F.lit(SHORT_TOKEN), F.lit(0))
    one = docs.select(F.explode(tokens).alias("t"))
    pairs = F.transform(F.sequence(F.lit(0), F.length("t") - 1), lambda i: F.substring(F.col("t"), i, F.when(i == 0, 1).otherwise(2)))
    met = one.select(F.explode(pairs).alias("pair"))
    rows = met.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).collect()
    return {("", r.pair) if len(r.pair) == 1 else (r.pair[0], r.pair[1]): r.n for r in rows}


def _kind(symbol: str) -> str:
    if not symbol:
        return ""
    return "l" if symbol.islower() else "u" if symbol.isupper() else "d" if symbol.isdigit() else "o"


def _inside(before: str, letter: str) -> bool:
    """Whether a letter goes on with the word of the one before, rather than starts one."""
    return before.isalpha() and not (before.islower() and letter.isupper())


class Chains:
    """A chain for each alphabet, from the list and the pairs of characters met in a corpus."""

    def __init__(self, alphabets: list[str], met: dict[tuple[str, str], int] | None = None):
        self.alphabets = alphabets
        self.first = Counter(w[0] for w in WORDS)
        self.pairs = Counter(p for w in WORDS for p in zip(w, w[1:], strict=False))
        steps = {k: Counter({c: PRIOR * p for c, p in zip(CLASSES, row, strict=True)}) for k, row in STEPS.items()}
        for (before, after), n in (met or {}).items():
            steps[_kind(before)][_kind(after)] += n
            if after.isalpha():
                if _inside(before, after):
                    self.pairs[before.lower(), after.lower()] += n
                else:
                    self.first[after.lower()] += n
        self.steps = {k: {c: max(LEAST_STEP, row[c] / row.total()) for c in CLASSES} for k, row in steps.items()}
        self.left, self.letters = Counter(), Counter(self.first)
        for (a, b), n in self.pairs.items():
            self.left[a] += n
            self.letters[b] += n

    def _starts(self, letter: str) -> float:
        return 0.5 * self.first[letter] / self.first.total() + 0.35 * self.letters[letter] / self.letters.total() + 0.15 / 26

    def _follows(self, before: str, letter: str) -> float:
        if not self.left[before]:
            return self._starts(letter)
        return 0.8 * self.pairs[before, letter] / self.left[before] + 0.15 * self._starts(letter) + 0.05 / 26

    def chances(self, before: str, alphabet: str) -> list[float]:
        """Of each symbol of the alphabet after `before` ("" at the start); they sum to 1."""
        kinds = [_kind(s) for s in alphabet]
        step = {c: self.steps[_kind(before)][c] for c in CLASSES if c in kinds}

        def weight(s: str) -> float:
            if not s.isalpha():
                return 1.0
            return self._follows(before.lower(), s.lower()) if _inside(before, s) else self._starts(s.lower())

        weights = [weight(s) for s in alphabet]
        of_class = {c: sum(w for w, k in zip(weights, kinds, strict=True) if k == c) for c in step}
        return [step[k] / sum(step.values()) * w / of_class[k] for w, k in zip(weights, kinds, strict=True)]

    def ratios(self, alphabet: str) -> list[float]:
        """log10 of chain over uniform chance: a row for the start and one for each symbol before."""
        return [math.log10(q * len(alphabet)) for before in ["", *alphabet] for q in self.chances(before, alphabet)]

    def evidence(self, numbers: Column, size: Column) -> Column:
        """-log10 of the p-value (at least 0) of a token made of words. `numbers` are its symbols' places in
        its alphabet, from 1; `size` tells the alphabet, and those of one size must have about equal ratios.

        The alphabet is inferred from the token, so the uniform likelihood counts as the mean over alphabets.
        """
        own = {len(a): self.ratios(a) for a in self.alphabets}
        assert all(max(abs(x - y) for x, y in zip(own[len(a)], self.ratios(a), strict=True)) < 1e-9 for a in self.alphabets)
        at, place = 0, F.when(F.lit(False), F.lit(0))
        for k, values in own.items():
            place, at = place.when(size == k, F.lit(at)), at + len(values)
        flat = F.split(F.lit(" ".join(f"{v:.4f}" for values in own.values() for v in values)), " ").cast("array<double>")
        before = F.concat(F.array(F.lit(0.0)), F.slice(numbers, 1, F.size(numbers) - 1))
        index = lambda a, b: (place + a * size + b).cast("int")
        likelier = F.aggregate(F.zip_with(before, numbers, lambda a, b: F.element_at(flat, index(a, b))), F.lit(0.0), lambda s, v: s + v)
        return F.greatest(F.lit(0.0), -likelier - math.log10(len(self.alphabets)))
