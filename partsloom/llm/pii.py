"""Problem 8: personal data in free text, found by bootstrapped contextual extraction.

Candidates are proposed widely: runs of digits and of letters with digits, street-like pieces
with a number, pairs and runs of words that have the make-up of a full name. Some are seeds,
whose shape tells their type (a number with a country prefix, an address with a street word, a
name in front of an address or a number). Every candidate has lexical patterns: its contexts
(words to the left and right) and its spellings (the masked shape of a number, the words of a
name or an address). Spark scores the graph of patterns and instances in rounds: spellings by
the labels that contexts gave their instances, contexts by the labels that spellings gave. A
pattern that is confident labels the instances it holds. What comes out is decided by learned
patterns alone: without them only emails and numbers with a country prefix are found. The
seeds' shapes are patterns like others, so contexts overrule them where they weigh more.

Patterns are learned from all texts and applied to all texts, two narrow passes. The second
looks for names in any case at places whose context may be a learned pattern: it asks a Bloom
filter of bounded size. Patterns measured to be few (`BROADCAST_ROWS`, `BROADCAST_BYTES`) are
broadcast and decide on the spot; more are joined with the candidates in Spark. So nothing that
grows without bound is broadcast, and no pattern is dropped for room. Shuffled are distinct
instances, counts by pattern and, with many patterns, candidates; not texts.

Defined results: null, empty and blank texts give no spans and come out unchanged; spans of
one text don't overlap; the same value twice gives two spans; equal rows give equal spans each;
a null or repeated key is carried through as it is. In a corpus where nothing is seen
three times nothing is learned; give `patterns` learned elsewhere there.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsloom.llm import tokens as K
from partsloom.llm.gates import Gate, Shared, gate_here, gate_of, shared_gate
from partsloom.session import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, cut_lineage, measured

#: Support of a pattern, and of spellings of addresses, names behind a form of address and Japanese names, most of which
#: are seeds; shares of a pattern's instances that must have its type.
SUPPORT, SEED_SUPPORT = 3, 2
NUMBER_CONFIDENCE, NAME_CONFIDENCE, ADDRESS_CONFIDENCE, WORD_SHARE, KNOWN_WORDS = 0.9, 0.6, 0.6, 0.1, 0.4
ROUNDS = 3  # at most
#: Code points handled at once, in whole texts.
CHUNK = 200_000

_L = r"[^\W\d_]"
_E = r"(?![A-Za-z0-9])"

# Shapes, street words, forms of address.
EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9_%+\-]+(?:\.[A-Za-z0-9_%+\-]+)*"
    r"(?:\s?[@＠]\s?|\s?[\[({]\s?at\s?[\])}]\s?|\s+at\s+(?=[\w\-]+\s+dot\s+)|\s+arroba\s+)"
    r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\s+dot\s+)[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)+",
    re.I,
)
_UNIT = r"(?:Flat|Apt\.?|Apartment|Unit|Suite)"
_EN_STREET = r"(?:Street|St\.?|Road|Rd|Lane|Ln|Avenue|Ave|Close|Court|Drive|Way|Terrace|Crescent|Place|Square|Grove|Mews)"
_FR_STREET = r"(?:rue|avenue|impasse|chemin|allée|boulevard|quai|place|cours|route|passage|square)"
_ES_STREET = r"(?:Calle|C/|Avenida|Avda\.?|Av\.|Pza\.?|P\.?º|Paseo|Plaza|Camino|Ronda|Carrera|Travesía)(?!\w)"
_DE_STREET = r"(?:weg|gasse|straße|strasse|str\.|platz|allee|ufer|damm|ring|steig|pfad)"
ADDRESSES = (
    re.compile(rf"(?<!\w)\d{{1,4}}(?:\s?(?:bis|ter|quater))?,?\s+{_FR_STREET}\s+(?:(?:de\s+la|du|des|de\s+l['’]|de|d['’]|la|le|les)\s*)?(?:[A-ZÀ-Þ][\w'’\-]*)(?:\s+[A-ZÀ-Þ][\w'’\-]*)*"),
    re.compile(rf"(?<!\w)\d{{1,4}}(?:\s?(?:bis|ter|quater))?,?\s+{_FR_STREET}\s+(?:de\s+la|du|des|de\s+l['’]|de|d['’]|la|le|les)\s*{_L}+(?:\s+{_L}+){{0,2}}(?=\s*[.,;:!\n]|\s*$)", re.I),
    re.compile(rf"(?<!\w){_ES_STREET}\s*(?:{_L}[\w'’\-]*\s+){{0,4}}?{_L}[\w'’\-]*(?:,)?\s+(?:n\.?\s?[º°o]\s*)?\d{{1,4}}(?!\w)(?:,\s*(?:bajo|ático|entresuelo|\d{{1,2}}\.?[º°](?:\s*[A-Z](?!\w))?))?", re.I),
    re.compile(rf"(?<!\w)(?:{_UNIT}\s+\d+[a-z]?,\s*)?\d{{1,4}}[a-z]?\s+(?:{_L}[\w'’\-]*\s+){{1,3}}?{_EN_STREET}(?!\w)(?:,\s*{_UNIT}\s+\d+[a-z]?(?!\w))?", re.I),
    re.compile(rf"(?<![\w\-])(?:{_L}[\w\-]*?{_DE_STREET}|{_L}[\w\-]*+\s+(?:Straße|Str\.|Weg|Gasse|Platz|Allee))\s+\d{{1,4}}\s?[a-z]?(?!\w)", re.I),
    re.compile(r"[㐀-鿿々ヶケ]{2,}(?<!\d)\d{1,2}-\d{1,2}(?:-\d{1,3})?(?![\d\-])"),
)
#: Pieces that may be addresses though no street word is known for them: a number before capitalised words, or
#: behind them within a sentence.
_TITLED = r"[A-ZÀ-Þ][^\W\d_A-ZÀ-Þ][\w'’\-]*+"
STREETLIKE = re.compile(
    rf"(?<![\w.,\-])\d{{1,4}}[a-z]?\s(?:{_TITLED}(?:[ \t](?=[A-ZÀ-Þ][^\W\d_A-ZÀ-Þ]))?){{2,}}+"
    rf"|(?<=[\w,:;][ \t])(?:{_TITLED}[ \t]){{1,3}}+\d{{1,4}}[a-z]?(?![\w\-]|[.,]\d)"
)
ID_SHAPES = tuple(
    re.compile(p, re.I)
    for p in (
        r"[A-Z]{1,2}\d{7}",  # passport
        r"[A-Z]\d{2}[A-Z]\d{2}[A-Z]\d{2}",  # identity card
        r"[A-Z]\d{3}-\d{4}-\d{4}",  # driving licence
        r"\d{8}[ \-]?[A-Z]",  # DNI
        r"\d{3}[ \-]\d{2}[ \-]\d{4}",  # SSN
        r"\d{2} \d{3} \d{3} \d{3}",  # tax id
        r"[12] \d{2} \d{2} \d{2} \d{3} \d{3}(?: \d{2})?",  # social security
        r"\d{4} \d{4} \d{4}",  # My Number
    )
)
COUNTRY_SHAPES = tuple(re.compile(p) for p in (r"\+\d.{7,}", r"00\d{2} .{7,}"))
PHONE_SHAPES = tuple(re.compile(p) for p in (r"\(\d{3}\) \d{3}-\d{4}", r"\d{3}[.\-]\d{3}[.\-]\d{4}", r"0\d0[ \-]\d{4}[ \-]\d{4}", r"\d{2}(?:[ .]\d{2}){4}"))
#: Seeds of numbers that aren't personal: order, batch and serial numbers.
OTHER_SHAPES = tuple(re.compile(p, re.I) for p in (r"\d{3}-\d{4}-\d{2}", r"\d{8}-\d", r"[A-Z]{2}\d{3}-\d{5}"))
FORMS = ("mr", "mrs", "ms", "miss", "mister", "frau", "herr", "herrn", "mme", "mlle", "madame", "monsieur", "sr", "sra", "srta", "señor", "señora", "señorita")
PARTICLES = ("van", "von", "der", "den", "de", "del", "da", "di", "du", "la", "le", "los", "y", "zu")
#: `M.` is a form of address in front of these, otherwise an initial.
_AFTER_M = ("du", "de", "des", "a", "est", "ne", "qui", "au")

_GAP = r"(?:\)?[  .\-/]\(?|\)\(?|\()"
NUMBER = re.compile(
    rf"(?<![A-Za-z0-9])(?:\d{{8}}[ \-]?[A-Za-z]{_E}"
    rf"|(?=[A-Za-z]*+[0-9\-])(?=[0-9\-]*+[A-Za-z])[A-Za-z0-9]++(?:-[A-Za-z0-9]++)*+"
    rf"|(?<![+(])(?=[+(]{{0,2}}\d(?:[  ().\-/]{{0,3}}\d){{4}})[+(]{{0,2}}\d++(?:{_GAP}\d++)*{_E})"
)
_JA_SUR, _JA_GIVEN = r"[㐀-鿿々ヶケ]{2,3}", r"(?:[㐀-鿿々]{1,3}|[ぁ-ゖ]{2,8}?|[ァ-ヺ]{2,8})"
JA_HONORED = re.compile(rf"(?<![㐀-鿿々ヶケ])({_JA_SUR}[ 　]?{_JA_GIVEN})(?:さん|様|氏)")
JA_SPACED = re.compile(rf"(?<![㐀-鿿々ヶケ])({_JA_SUR}[ 　](?:[㐀-鿿々]{{1,3}}|[ぁ-ゖ]{{2,4}}|[ァ-ヺ]{{2,8}}))(?![㐀-鿿々ヶケ])")
JA_BLOCK = re.compile(rf"(?<![㐀-鿿々ヶケ])({_JA_SUR}[ 　]?(?:[㐀-鿿々]{{1,3}}|[ぁ-ゖ]{{2,8}}|[ァ-ヺ]{{2,8}}))$")

#: What a text must hold for a shape to be looked for (linear-time supersets of the shapes above).
_MAY_EMAIL = r"(?i)[@＠]|[\[({]\s?at\s?[\])}]|\sat\s+[^\s]+\s+dot\s|\sarroba\s"
_MAY_NUMBER = r"(?:[0-9][ \x{a0}().\-/+]{0,3}){4}[0-9]|(?:[A-Za-z\-]*[0-9]){5}"
_MAY_FRENCH = rf"(?i)[0-9](?:\s?(?:bis|ter|quater))?,?\s+{_FR_STREET}\s"
#: The same for each of `ADDRESSES`.
_MAY_ADDRESSES = (
    _MAY_FRENCH,
    _MAY_FRENCH,
    r"(?i)(?:Calle|C/|Avenida|Avda|Av\.|Pza|P\.?º|Paseo|Plaza|Camino|Ronda|Carrera|Travesía)\s*\S",
    rf"(?i)[0-9][a-z]?\s+(?:\S+\s+){{1,3}}{_EN_STREET}",
    rf"(?i){_DE_STREET}\s+[0-9]",
    r"[㐀-鿿々ヶケ][0-9]{1,2}-[0-9]",
)
_MAY_STREETLIKE = r"[0-9][a-z]?\s[A-ZÀ-Þ]\p{Ll}\S*\s[A-ZÀ-Þ]\p{Ll}|[^\s.!?][ \t][A-ZÀ-Þ]\p{Ll}\S*[ \t][0-9]"
_MAY_JAPANESE = r"[㐀-鿿]{2}"
#: What a text without any of these must hold to teach something: two capitalised words or a form of address.
_MAY_TEACH = rf"\p{{Lu}}[\p{{L}}\p{{M}}'’\-]*(?:,\s*|\.\s*|\s+|-)\p{{Lu}}|(?i:{'|'.join(FORMS)})"

_WORD = re.compile(rf"{_L}+")
_SHAPE = re.compile(rf"\d+|{_L}+")
#: Digits enough for a candidate, near each other or within one word.
_ENOUGH = re.compile(r"\d(?:[  ().\-/]{0,3}\d){4}|\d(?:[A-Za-z\-]*+\d){4}")
_MANY = 5, 8, 6  # digits of a number that is a candidate; of one that is folded to a token; of one with letters

_CODES = {name: np.array([K.code_of(w) for w in words], dtype=np.uint64) for name, words in (("forms", FORMS), ("particles", PARTICLES), ("hyphen", "-"), ("comma", ","), ("slash", "/"))}


def _either(shapes) -> str:
    return "|".join(f"(?:{s.pattern})" for s in shapes)


_LABELS = re.compile(rf"(?P<none>{_either(OTHER_SHAPES)})|(?P<id>{_either(ID_SHAPES)})|(?P<phone>{_either(COUNTRY_SHAPES + PHONE_SHAPES)})", re.I)
_COUNTRY = re.compile(_either(COUNTRY_SHAPES))
_MASK = str.maketrans({c: "9" if c.isdigit() else "A" for c in map(chr, range(128)) if c.isalnum()})


def label_of(value: str) -> str | None:
    """The type a seed's shape gives away: none (order, batch, serial), id, phone, or null."""
    m = _LABELS.fullmatch(value)
    return m.lastgroup if m else None


def mask(value: str) -> str:
    """The shape of a number: digits as 9, letters as A."""
    return value.translate(_MASK)


def _numbers(text: str):
    """What `NUMBER.finditer` gives with enough digits, looked for only where there are so many."""
    at = 0
    while m := _ENOUGH.search(text, at):
        first = start = m.start()
        while start > at and (text[start - 1].isalnum() or text[start - 1] == "-"):
            start -= 1
        # From the run's beginning, with signs before it, up to the digit.
        end = 0
        for k in range(max(at, start - 2), first + 1):
            if found := NUMBER.match(text, k):
                end = found.end()
                if end > first:
                    yield found
                    break
        at = max(end, first + 1)


def shapes_of(text: str, email: bool, number: bool, addresses: tuple, streetlike: bool) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(spans folded to tokens, spans only proposed) of a text, each sorted and without overlaps.

    The flags say which shapes are worth looking for; `addresses` are the shapes themselves.
    """
    spans: list[tuple[int, int, str]] = []
    loose: list[tuple[int, int, str]] = []
    free = text

    def take(found, kind):
        nonlocal free
        new = [m.span() for m in found if "\x00" not in m.group()]
        if not new:
            return
        spans.extend((a, b, kind) for a, b in new)
        parts, at = [], 0
        for a, b in new:
            parts += [free[at:a], "\x00" * (b - a)]
            at = b
        free = "".join([*parts, free[at:]])

    if email:
        take(EMAIL.finditer(free), "email")
    for shape in addresses:
        take(shape.finditer(free), "address")
    if number:
        few = []
        for m in _numbers(free):
            digits = sum(map(str.isdigit, m.group()))
            if digits >= _MANY[0]:
                few.append((m, digits >= (_MANY[2] if re.search("[A-Za-z]", m.group()) else _MANY[1])))
        take((m for m, whole in few if whole), "number")
        loose += [(*m.span(), "number") for m, whole in few if not whole]
    if streetlike:
        loose += [(*m.span(), "address") for m in STREETLIKE.finditer(free) if "\x00" not in m.group()]
    return sorted(spans), sorted(loose)


def japanese_names(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, bool]]:
    """(start, end, seed): names with an honorific or in front of an address, and spaced ones that may be names."""
    out = {m.span(1): True for m in JA_HONORED.finditer(text)}
    for a, _, kind in spans:
        if kind == "address":
            end = len(text[:a].rstrip(" 　")) if text[a - 1 : a] in (" ", "　") else a
            if m := JA_BLOCK.search(text, max(0, end - 12), end):
                out[m.span(1)] = True
    for m in JA_SPACED.finditer(text):
        if all(m.end(1) <= a or b <= m.start(1) for a, b in out):
            out[m.span(1)] = False
    return [(a, b, seed) for (a, b), seed in sorted(out.items())]


def tells(side: str, left: list[str], right: list[str]) -> bool:
    """Whether a name's context has words of its own: one to the left in a pattern of two words left,
    or two to the right, or an entity to the right; not across the end of a sentence."""
    own = []
    for t in right:
        if t == "<b>":
            break
        own.append(t)
    words = [t for t in own if t.isalpha() or t.startswith("<")]
    if any(t in ("<a>", "<n>") for t in words) or len(words) > 1:
        return True
    if side != "B":
        return False
    near = []
    for t in reversed(left):
        if t == "<b>":
            break
        near.append(t)
    return any(t.isalpha() or t.startswith("<") for t in near)


class Reader:
    """A batch of texts with its tokens and the candidates in it."""

    def __init__(self, texts: list[str], flags: list[tuple[bool, ...]]):
        self.texts, self.spans, self.loose, self.japanese = texts, [], [], []
        entities = []
        for t, (text, (email, number, streetlike, kanji, addresses)) in enumerate(zip(texts, flags)):
            spans, loose = shapes_of(text, email, number, addresses, streetlike) if email or number or addresses or streetlike else ([], [])
            entities += [(t, *s) for s in spans]
            self.spans += [(t, *s) for s in spans]
            self.loose += [(t, *s) for s in loose]
            if kanji:
                self.japanese += [(t, *s) for s in japanese_names(text, spans)]
        self.s = K.Stream(texts, entities)

    # -- full names: arrays of (first token, token behind the last)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        s, n = self.s, self.s.n
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places = np.arange(n)
        word, code = s.word, s.code
        form, particle = np.isin(code, _CODES["forms"]), np.isin(code, _CODES["particles"])
        touch = np.append(s.end[:-1] == s.begin[1:], False)
        near = np.append(word[1:], False)
        hyphen = (s.kind == K.SINGLE) & np.isin(code, _CODES["hyphen"]) & touch & np.roll(touch, 1) & near & np.roll(word, 1)
        chain = hyphen | (word & (np.append(hyphen[1:], False)))
        after = np.minimum(K.run_end(chain) + 1, n)  # behind the last word of a hyphenated one
        after = np.where(word, after, places)
        letter = (s.kind == K.LETTER) & ~word
        dotted = letter & touch & np.append(s.dot[1:], False)
        initial = dotted | np.concatenate([[False], dotted[:-1]])
        past = K.run_end(initial)

        def get(array, i, default=False):
            return np.where(i < n, array[np.minimum(i, n - 1)], default)

        firsts, lasts = [], []

        def add(ok, i, j):
            firsts.append(i[ok])
            lasts.append(j[ok])

        # Initials, then a family name.
        i = places[dotted]
        k = past[i]
        add(get(word, k), i, get(after, k, 0))
        # A given name, initials, a family name; further ones with particles between them.
        i = places[word & ~form]
        j = after[i]
        k = np.where(get(dotted, j), get(past, j, n), j)
        for step in range(3):
            ok = get(word, k) & ~get(form, k)
            i, k = i[ok], k[ok]
            e = after[k]
            whole = self.cased(i, e) if step else np.ones(len(i), dtype=bool)
            if step:
                i, e = i[whole], e[whole]
            add(np.ones(len(i), dtype=bool), i, e)
            k = e
        i = places[word & ~form]
        k = after[i]
        for _ in range(3):
            ok = get(particle, k)
            i, k = i[ok], k[ok] + 1
            last = get(word, k) & get(s.cap, k) & ~get(particle, k)
            add(last, i, get(after, k, 0))
        # A family name, a comma, a given name.
        i = places[word & ~form]
        j = after[i]
        ok = np.isin(get(code, j, np.uint64(0)), _CODES["comma"]) & get(word, j + 1)
        i, j = i[ok], after[j[ok] + 1]
        add(np.ones(len(i), dtype=bool), i, j)
        add(get(dotted, j), i, j + 2)
        i, j = np.concatenate(firsts), np.concatenate(lasts)
        order = np.lexsort((j, i))
        i, j = i[order], j[order]
        fresh = np.ones(len(i), dtype=bool)
        fresh[1:] = (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        return i[fresh], j[fresh]

    def _sum(self, flags: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(flags)])

    def cased(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_small"):
            self._small = self._sum(self.s.word & ~self.s.cap)
        return self._small[j] == self._small[i]

    def titled(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_loud"):
            self._loud = self._sum(self.s.word & self.s.all_upper)
        return self.cased(i, j) & (self._loud[j] == self._loud[i])

    def begins(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """A capitalised run can't be entered in its middle."""
        s = self.s
        p = i - 1
        inside = (p >= 0) & s.word[p] & s.cap[p] & self.cased(i, j) & ~np.isin(s.code[p], _CODES["forms"])
        return ~(inside & (s.end[p] + 1 == s.begin[i]) & (s.at(i - 2) != K.B))

    def block(self, j: np.ndarray) -> np.ndarray:
        """Whether an address or a number of a contact block follows."""
        r = [self.s.at(j + x) for x in range(4)]
        comma, slash = (np.isin(r[0], _CODES[x]) for x in ("comma", "slash"))
        mail = (np.isin(r[2], _CODES["comma"]) & comma | np.isin(r[2], _CODES["slash"]) & comma) & (r[1] == K.N) & (r[3] == K.E)
        return slash & (r[1] == K.N) | comma & (r[1] == K.A) | mail

    def gates(self, i: np.ndarray, j: np.ndarray) -> list[np.ndarray]:
        at = self.s.at
        return [
            K.combine(1, at(i - 2), at(i - 1), at(j)),
            K.combine(2, at(i - 1), at(j), at(j + 1)),
            K.combine(3, at(j), at(j + 1), at(j + 2)),
        ]

    def name_keys(self, i: int, j: int) -> list[str]:
        show = self.s.show
        left, right = [show(i - 2), show(i - 1)], [show(j), show(j + 1), show(j + 2)]
        out = []
        for side, a, b in (("B", left, right[:1]), ("A", left[1:], right[:2]), ("R", [], right)):
            out.append(f"w{side if tells(side, a, b) else side.lower()} {' '.join(a)} | {' '.join(b)}")
        return out

    def side_keys(self, kind: str, i: int, j: int) -> list[str]:
        """Contexts of tokens i..j-1: two to the left, one on either side, two to the right."""
        show = self.s.show
        l2, l1, r1, r2 = show(i - 2), show(i - 1), show(j), show(j + 1)
        return [f"{kind}L {l2} {l1}", f"{kind}M {l1} | {r1}", f"{kind}R {r1} {r2}"]

    def words_of(self, i: int, j: int) -> list[str]:
        return [f"w {self.s.show(k)}" for k in range(i, j) if self.s.word[k]]

    def places(self, rows: list[tuple]) -> list[tuple[int, int]]:
        """First token and token behind the last of spans (text, start, end, ...)."""
        if not rows:
            return []
        t, a, b = (np.fromiter((r[k] for r in rows), dtype=np.int64, count=len(rows)) for k in range(3))
        x = self.s.base[t]
        return list(zip(np.searchsorted(self.s.begin, x + a).tolist(), np.searchsorted(self.s.begin, x + b).tolist()))

    def shaped(self):
        """(text, start, end, kind, label, sure, marks, contexts) of all candidates but names in tokens."""
        for rows, firm in ((self.spans, True), (self.loose, False)):
            for (t, a, b, kind), (i, j) in zip(rows, self.places(rows)):
                value = self.texts[t][a:b]
                if kind == "email":
                    yield t, a, b, "e", "email", True, [], []
                elif kind == "number":
                    sure = firm and _COUNTRY.fullmatch(value) is not None
                    yield t, a, b, "n", label_of(value), sure, [f"n# {mask(value)}"], self.side_keys("n", i, j)
                else:
                    words = [f"a {w}" for w in dict.fromkeys(_WORD.findall(value.lower()))]
                    yield t, a, b, "a", "address" if firm else None, False, [*words, f"a# {_SHAPE.sub(lambda m: '9' if m[0][0].isdigit() else 'w', value)}"], self.side_keys("a", i, j)
        for (t, a, b, seed), (i, j) in zip(self.japanese, self.places(self.japanese)):
            value = self.texts[t][a:b]
            yield t, a, b, "j", "name" if seed else None, False, [f"j {value[:2]}", f"j+ {re.sub('^.[^ 　]{1,2}[ 　]?', '', value)}"], self.side_keys("j", i, j)

    def addressed(self) -> list[tuple[int, int, int]]:
        """(form's token, first token, token behind the last) of family names right behind a form of address."""
        s, out = self.s, []
        for f in np.flatnonzero(np.isin(s.code, _CODES["forms"]) & s.word):
            i = f + 1
            if i < s.n and s.raw(i) == "." and s.end[f] == s.begin[i]:
                i += 1
            if i < s.n and s.word[i] and (s.cap[i] or not s.cap[f]) and s.owner(i) == s.owner(f):
                j = i + 1
                while j + 1 < s.n and s.raw(j) == "-" and s.end[j - 1] == s.begin[j] and s.end[j] == s.begin[j + 1] and s.word[j + 1]:
                    j += 2
                out.append((int(f), int(i), int(j)))
        return out


def _chunks(texts: list[str], flags: list[tuple[bool, ...]]):
    """Batches of whole texts, bounded by code points."""
    start = size = 0
    for n, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield start, Reader(texts[start : n + 1], flags[start : n + 1])
            start, size = n + 1, 0
    if start < len(texts):
        yield start, Reader(texts[start:], flags[start:])


def _readers(column, teaching: bool = False):
    """(place of the first text, reader) over an Arrow column of texts; with `teaching` only of those that can teach."""
    import pyarrow.compute as pc

    shapes = [pc.match_substring_regex(column, p) for p in (_MAY_EMAIL, _MAY_NUMBER, _MAY_STREETLIKE, _MAY_JAPANESE)]
    address = pc.match_substring_regex(column, "|".join(dict.fromkeys(_MAY_ADDRESSES)))
    if teaching:
        useful = pc.match_substring_regex(column, _MAY_TEACH)
        for s in (*shapes, address):
            useful = pc.or_(useful, s)
        column, address, shapes = column.filter(useful), address.filter(useful), [s.filter(useful) for s in shapes]
    some = column.filter(address)
    which = iter(zip(*[pc.match_substring_regex(some, p).to_pylist() for p in _MAY_ADDRESSES]))
    found = [tuple(s for s, w in zip(ADDRESSES, next(which)) if w) if a else () for a in address.to_pylist()]
    shapes = [*[s.to_pylist() for s in shapes], found]
    yield from _chunks(column.to_pylist(), list(zip(*shapes)))


def _signed(x: np.ndarray) -> list[int]:
    return x.astype(np.int64).tolist()


_CANDIDATE = "kind string, label string, marks array<string>, keys array<string>, gates array<bigint>"


def _readable(df: DataFrame, key: str | None, text: str) -> DataFrame:
    cols = [F.col(text).alias("t")] + ([F.col(key).alias("k")] if key else [])
    return df.select(*cols).where(F.col("t").isNotNull() & (F.trim("t") != ""))


def candidate_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """What patterns are learned from: shaped candidates, addressed and capitalised names of all texts."""

    def run(batches):
        import pyarrow as pa

        kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
        for batch in batches:
            rows = []
            for _, r in _readers(batch.column(0), teaching=True):
                rows += [(kind, label, marks, keys, []) for _, _, _, kind, label, _, marks, keys in r.shaped() if keys]
                rows += [("f", "name", r.words_of(i, j), [f"f {r.s.show(f)}"], []) for f, i, j in r.addressed()]
                i, j = r.names()
                ok = r.titled(i, j)
                i, j = i[ok], j[ok]
                seed = r.block(j) & r.begins(i, j)
                gates = np.stack(r.gates(i, j), axis=1) if len(i) else np.zeros((0, 3), np.uint64)
                for x, y, s, g in zip(i.tolist(), j.tolist(), seed.tolist(), gates):
                    rows.append(("w", "name" if s else None, r.words_of(x, y), r.name_keys(x, y), _signed(g)))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["kind", "label", "marks", "keys", "gates"])

    return _readable(df, None, text).mapInArrow(run, _CANDIDATE)


_TYPES = ("phone", "id", "none", "address", "name")


def _tallies(instances: DataFrame, by: str, label: str) -> DataFrame:
    """(key, total, labelled, type, hits, gate) of patterns: instances, those with a label, the commonest label."""
    with_gate = by == "keys"
    cell = F.arrays_zip(F.col("keys").alias("key"), F.col("gates").alias("gate")) if with_gate else F.transform(F.array_distinct(by), lambda m: F.struct(m.alias("key"), F.lit(None).cast("bigint").alias("gate")))
    flat = instances.select(F.explode(cell).alias("c"), "n", F.col(label).alias("l")).select("c.key", "c.gate", "n", "l")
    sums = [F.sum(F.when(F.col("l") == t, F.col("n")).otherwise(0)).alias(f"t_{t}") for t in _TYPES]
    out = flat.groupBy("key").agg(F.sum("n").alias("total"), F.first("gate").alias("gate"), *sums)
    best = F.greatest(*[F.struct(F.col(f"t_{t}").alias("hits"), F.lit(t).alias("type")) for t in _TYPES])
    return out.select("key", "gate", "total", sum((F.col(f"t_{t}") for t in _TYPES), F.lit(0)).alias("labelled"), best.alias("b")).select("key", "gate", "total", "labelled", "b.*")


def _promoted(tallies: DataFrame, spelling: bool) -> DataFrame:
    """(key, type, score, gate) of confident patterns."""
    kind = F.substring("key", 1, 1)
    told, share = F.col("hits") / F.col("labelled"), F.col("hits") / F.col("total")
    number = (F.col("hits") >= SUPPORT) & (told >= NUMBER_CONFIDENCE)
    support = F.when(kind.isin(*(["a", "f", "j"] if spelling else ["f", "j"])), SEED_SUPPORT).otherwise(SUPPORT)
    if spelling:
        ok = F.when(kind == "n", number & (share >= 0.5)).when(kind == "a", (F.col("hits") >= support) & (share >= ADDRESS_CONFIDENCE)).otherwise(share >= WORD_SHARE)
    else:
        ok = F.when(kind == "n", number).otherwise((F.col("hits") >= support) & (share >= F.when(kind == "a", ADDRESS_CONFIDENCE).otherwise(NAME_CONFIDENCE)))
    # A number's shape is common to many corpora of numbers, so it weighs half as much as a context.
    weight = F.when(kind == "n", told * F.log1p("labelled") * (0.5 if spelling else 1.0)).otherwise(share * F.log1p("total"))
    return tallies.where((F.col("hits") > 0) & ok).select("key", "type", weight.alias("score"), "gate")


def _votes(nodes: DataFrame, by: str, patterns: DataFrame) -> DataFrame:
    """(id, type, share): the type most of a node's patterns speak for, and the share of them that are known."""
    # The mere shape of an address labels nothing: `For 12` has that of `Gerbergasse 12`.
    told = F.filter(F.array_distinct(by), lambda k: ~k.startswith("a#"))
    flat = nodes.select("id", F.size(told).alias("size"), F.explode(told).alias("key"))
    hit = flat.join(broadcast_if_small(patterns.select("key", "type", "score")), "key")
    sums = [F.sum(F.when(F.col("type") == t, F.col("score")).otherwise(0.0)).alias(f"t_{t}") for t in _TYPES]
    out = hit.groupBy("id").agg(*sums, (F.count("*") / F.max("size")).alias("share"))
    best = F.greatest(*[F.struct(F.col(f"t_{t}").alias("score"), F.lit(t).alias("type")) for t in _TYPES])
    return out.select("id", best["type"].alias("type"), "share")


def learned_patterns(df: DataFrame, text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(key, type, score, gate) of the patterns the texts teach; `gate` is the code of a name's context."""
    rows = candidate_rows(df, text)
    # Instances of equal spelling and context are one node with a weight.
    nodes = rows.groupBy("kind", "label", "marks", "keys", "gates").agg(F.count("*").alias("n"))
    nodes = cut_lineage(nodes.withColumn("id", F.monotonically_increasing_id()))
    seen, before = nodes.withColumn("c", F.col("label")), None
    for step in range(rounds):
        marks = cut_lineage(_promoted(_tallies(seen, "marks", "c"), spelling=True))
        spoken = nodes.join(_votes(nodes, "marks", marks), "id", "left")
        known = F.when(F.col("share") > KNOWN_WORDS, F.col("type"))
        label = F.when(F.col("kind").isin("w", "f"), known).otherwise(F.coalesce("label", known))
        contexts = cut_lineage(_promoted(_tallies(spoken.withColumn("s", label), "keys", "s"), spelling=False))
        # The same patterns as in the round before: nothing more will be learned.
        now = tuple(contexts.agg(F.count("*"), F.bit_xor(F.xxhash64("key", "type"))).first())
        if now == before:
            break
        before = now
        if step < rounds - 1:
            seen = nodes.join(_votes(nodes, "keys", contexts), "id", "left").withColumn("c", F.coalesce("label", "type"))
    # Words of names and silent contexts taught others; they decide nothing alone.
    out = contexts.where(~F.substring("key", 1, 2).isin("wb", "wa", "wr"))
    return out.unionByName(marks.where(F.substring("key", 1, 1).isin("n", "a")))


_FOUND = "rid bigint, kind string, seed string, sure boolean, start_pos int, end_pos int, cluster int, keys array<string>, cased boolean, begins boolean, lead boolean, width int"


def _clusters(rows: list[list]) -> None:
    """Numbers of groups of overlapping candidates of a text, set at place 5."""
    rows.sort(key=lambda r: (r[3], r[4]))
    reach, number = -1, 0
    for r in rows:
        if r[3] >= reach:
            number += 1
        reach = max(reach, r[4])
        r[5] = number


def _found(r: Reader, gate: Gate) -> dict[int, list[list]]:
    """Text -> candidates that patterns may speak for: [kind, seed, sure, start, end, cluster, keys, cased, begins, lead, width]."""
    out: dict[int, list[list]] = {}
    s = r.s
    for t, a, b, kind, seed, sure, marks, keys in r.shaped():
        out.setdefault(t, []).append([kind, seed, sure, a, b, 0, [*keys, *marks], True, True, False, 0])

    def say(kind, i, j, keys, cased=True, begins=True, lead=False, width=0):
        t = int(s.owner(i))
        x = int(s.base[t])
        out.setdefault(t, []).append([kind, None, False, int(s.begin[i]) - x, int(s.end[j - 1]) - x, 0, keys, cased, begins, lead, width])

    for f, i, j in r.addressed():
        say("f", i, j, [f"f {s.show(f)}"])
    i, j = r.names()
    b, a, right = (gate.holds(g) for g in r.gates(i, j))
    cased, begins = r.cased(i, j), r.begins(i, j)
    ok = (b | a | right) & ((cased & begins) | b | a)
    for x, y, c, g in zip(i[ok].tolist(), j[ok].tolist(), cased[ok].tolist(), begins[ok].tolist()):
        first = x
        if s.show(x) == "m" and s.show(y) in _AFTER_M and not s.word[x]:
            first = x + 2
        if first < y:
            say("w", first, y, r.name_keys(x, y), c, g, s.show(x - 1) in ("<b>", ":"), y - x)
    for rows in out.values():
        _clusters(rows)
    return out


def _applied(df: DataFrame, key: str, text: str, patterns: DataFrame) -> DataFrame:
    """(rid, key, kind, ...) of all candidates of the second pass, cut off: their row numbers stay as they are."""
    from pyspark import TaskContext

    shared = shared_gate(df.sparkSession, gate_of(patterns.select("gate")))
    src = _readable(df, key, text)
    kind = src.schema["k"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        gate = shared.get()
        row = TaskContext.get().partitionId() << 40
        kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.bool_(), pa.bool_(), pa.bool_(), pa.int32()]
        for batch in batches:
            rows, owners = [], []
            for start, r in _readers(batch.column(0)):
                for t, found in _found(r, gate).items():
                    owners += [start + t] * len(found)
                    rows += [(row + start + t, *f) for f in found]
            row += batch.num_rows
            cols = list(zip(*rows)) or [()] * len(kinds)
            columns = [pa.array(c, k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(owners, pa.int64())), *columns], names=["k", *[f.split(" ")[0] for f in _FOUND.split(", ")]])

    return cut_lineage(src.mapInArrow(run, f"k {kind}, {_FOUND}"))


def _decided(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """(k, rid, pii_type, start_pos, end_pos): candidates that learned patterns speak for, without overlaps."""
    at = ["rid", "start_pos", "end_pos", "kind"]
    flat = found.where(F.size("keys") > 0).select(*at, F.explode("keys").alias("key"))
    hit = flat.join(broadcast_if_small(patterns.select("key", "type", "score")), "key")
    mark = F.substring("key", 2, 1).isin("#", " ") & F.substring("key", 1, 1).isin("n", "a")
    sums = [F.sum(F.when(F.col("type") == t, F.col("score")).otherwise(0.0)).alias(f"t_{t}") for t in _TYPES]
    votes = hit.groupBy(*at).agg(*sums, F.sum(F.when(mark, 0.0).otherwise(F.col("score"))).alias("near"), F.bool_or(F.substring("key", 1, 2).isin("wB", "wA")).alias("left"))
    rows = found.join(votes, at, "left")
    best = F.greatest(*[F.struct(F.col(f"t_{t}").alias("score"), F.lit(t).alias("type")) for t in ("phone", "id", "none")])
    name = (F.col("t_name") > 0) & ((F.col("cased") & F.col("begins")) | F.col("left"))
    kind = F.col("kind")
    what = (
        F.when(kind == "e", "email")
        .when((kind == "n") & F.col("near").isNotNull(), best["type"])
        .when((kind == "n") & F.col("sure"), F.col("seed"))
        .when((kind == "a") & (F.col("t_address") > 0) & (F.col("seed").isNotNull() | (F.col("near") > 0)), "address")
        .when((kind == "w") & name, "name")
        .when(kind.isin("f", "j") & (F.col("t_name") > 0), "name")
    )
    rank = (
        F.when(kind == "w", F.col("t_name") + 4 * F.col("cased").cast("int") + 2 * F.col("left").cast("int") + F.col("lead").cast("int") + 0.01 * F.col("width"))
        .when(kind == "f", 9.0)
        .otherwise(F.when(F.col("seed").isNotNull(), 100.0).otherwise(1.0))
    )
    rows = rows.withColumn("what", what).where("what is not null and what <> 'none'")
    span = F.struct((-rank).alias("r"), F.col("start_pos").alias("a"), F.col("end_pos").alias("b"), F.col("what").alias("w"))
    groups = rows.groupBy("rid", "cluster").agg(F.first("k").alias("k"), F.array_sort(F.collect_list(span)).alias("c"))
    apart = lambda kept, c: F.forall(kept, lambda x: (c["b"] <= x["a"]) | (x["b"] <= c["a"]))
    none = F.array().cast("array<struct<r:double,a:int,b:int,w:string>>")
    kept = F.aggregate("c", none, lambda kept, c: F.when(apart(kept, c), F.concat(kept, F.array(c))).otherwise(kept))
    out = groups.select("k", "rid", F.explode(kept).alias("s"))
    return out.select("k", "rid", F.col("s.w").alias("pii_type"), F.col("s.a").alias("start_pos"), F.col("s.b").alias("end_pos"))


class Judge:
    """Patterns at hand and the decision over a text's candidates: what `_decided` says in Spark."""

    def __init__(self, patterns: list[tuple[str, str, float, int | None]]):
        self.patterns = {k: (t, s) for k, t, s, _ in patterns}
        self.gate = gate_here(np.array([g for *_, g in patterns if g is not None], dtype=np.int64))

    def verdict(self, row: list) -> tuple[float, int, int, str] | None:
        """(-rank, start, end, type) of a candidate, or None."""
        kind, seed, sure, a, b, _, keys, cased, begins, lead, width = row
        if kind == "e":
            return -100.0, a, b, "email"
        sums, near, left, hit = {}, 0.0, False, False
        for key in keys:
            if p := self.patterns.get(key):
                hit = True
                sums[p[0]] = sums.get(p[0], 0.0) + p[1]
                if not (key[0] in "na" and key[1] in "# "):
                    near += p[1]
                left = left or key[:2] in ("wB", "wA")
        what = None
        if kind == "n":
            what = max((sums.get(t, 0.0), t) for t in ("phone", "id", "none"))[1] if hit else seed if sure else None
        elif kind == "a":
            what = "address" if sums.get("address", 0.0) > 0 and (seed or near > 0) else None
        elif sums.get("name", 0.0) > 0 and (kind != "w" or (cased and begins) or left):
            what = "name"
        if what is None or what == "none":
            return None
        rank = sums["name"] + 4 * cased + 2 * left + lead + 0.01 * width if kind == "w" else 9.0 if kind == "f" else 100.0 if seed else 1.0
        return -rank, a, b, what

    def spans(self, rows: list[list]) -> list[tuple[str, int, int]]:
        """(type, start, end) of a text's spans, best first within groups of overlapping candidates."""
        groups: dict[int, list] = {}
        for r in rows:
            if v := self.verdict(r):
                groups.setdefault(r[5], []).append(v)
        out = []
        for found in groups.values():
            kept: list[tuple] = []
            for v in sorted(found):
                if all(v[2] <= k[1] or k[2] <= v[1] for k in kept):
                    kept.append(v)
            out += [(w, a, b) for _, a, b, w in kept]
        return out

    def read(self, column):
        """(place, spans) of the texts of an Arrow column that have spans."""
        for start, r in _readers(column):
            for t, rows in _found(r, self.gate).items():
                if spans := self.spans(rows):
                    yield start + t, spans


def _few(patterns: DataFrame, most: int) -> bool:
    rows, size = measured(patterns)
    return rows <= most and size <= BROADCAST_BYTES


def _judge(patterns: DataFrame) -> Shared:
    rows = [tuple(r) for r in patterns.select("key", "type", "score", "gate").collect()]  # measured before
    return Shared(patterns.sparkSession, rows, Judge)


def personal_spans(df: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, patterns: DataFrame | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """(key, pii_type, start_pos, end_pos) in code points, end exclusive. `patterns`, if given, are used as they are.

    Up to `most` patterns (and BROADCAST_BYTES) are broadcast and candidates are decided where
    they are found; more are joined with the candidates in Spark, to the same result.
    """
    if patterns is None:
        patterns = cut_lineage(learned_patterns(df, text, rounds))
    if not _few(patterns, most):
        out = _decided(_applied(df, key, text, patterns), patterns)
        return out.select(F.col("k").alias(key), "pii_type", "start_pos", "end_pos")
    judge = _judge(patterns)
    src = _readable(df, key, text)

    def run(batches):
        import pyarrow as pa

        j = judge.get()
        for batch in batches:
            rows = [(n, *s) for n, spans in j.read(batch.column(0)) for s in spans]
            n, types, starts, ends = list(zip(*rows)) or [()] * 4
            columns = [batch.column(1).take(pa.array(n, pa.int64())), pa.array(types, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["k", "pii_type", "start_pos", "end_pos"])

    out = src.mapInArrow(run, f"k {src.schema['k'].dataType.simpleString()}, pii_type string, start_pos int, end_pos int")
    return out.withColumnRenamed("k", key)


def placeholder_text(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    if text is None:
        return None
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
            at = b
    return "".join([*out, text[at:]])


def redacted(df: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, patterns: DataFrame | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """(key, text): every text with its personal data replaced by typed placeholders."""
    if patterns is None:
        patterns = cut_lineage(learned_patterns(df, text, rounds))
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t"))
    if not _few(patterns, most):
        return _redacted_by_join(rows, patterns).withColumnRenamed("k", key)
    judge = _judge(patterns)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        j = judge.get()
        for batch in batches:
            texts = batch.column(1)
            out = texts.to_pylist()
            for n, spans in j.read(pc.fill_null(texts, "")):
                out[n] = placeholder_text(out[n], spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["k", "text"])

    return rows.mapInArrow(run, f"k {rows.schema['k'].dataType.simpleString()}, text string").withColumnRenamed("k", key)


def _redacted_by_join(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """(k, text) by a join with the spans, by key and hash of the text: a null or repeated key does no harm."""
    rows = rows.withColumn("h", F.sha2("t", 256))
    src = rows.where(F.col("t").isNotNull()).select(F.struct("k", "h").alias("id"), "t")
    spans = _decided(_applied(src, "id", "t", patterns), patterns)
    span = F.struct(F.col("start_pos").alias("a"), F.col("end_pos").alias("b"), "pii_type")
    # Spans of one text, however often it is delivered: as many as the text holds.
    spans = spans.groupBy("k").agg(F.array_sort(F.collect_set(span)).alias("spans")).select(F.col("k.k").alias("_k"), F.col("k.h").alias("_h"), "spans")
    joined = rows.join(spans, F.col("k").eqNullSafe(F.col("_k")) & (F.col("h") == F.col("_h")), "left")
    step = lambda at, s: F.struct(F.concat(at["out"], F.substring(F.col("t"), at["at"] + 1, s["a"] - at["at"]), F.lit("["), F.upper(s["pii_type"]), F.lit("]")).alias("out"), s["b"].alias("at"))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate("spans", start, step, lambda at: F.concat(at["out"], F.substring(F.col("t"), at["at"] + 1, F.lit(2147483647) - at["at"] - 1)))
    return joined.select("k", F.when(F.col("spans").isNull(), F.col("t")).otherwise(done).alias("text"))
