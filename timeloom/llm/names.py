"""Names read off a screen: one comparable form, a misreading distance, and matching against a reference list.

The words of the reference list are a trie (:class:`Vocabulary`), each reachable by itself and by alias paths (its usual
abbreviations); it is searched by a Levenshtein automaton that allows each word a number of misreadings depending on
its length, and returns all words within it. The entries are a trie of phrases over these words (:class:`Phrases`), in
which an entry is reachable by its label, its aliases and their rotations (a name may be shown as ``Settlement - Tanker
4``). Words run together or torn apart are searched for as one string in a trie of whole entries by the same automaton.

Either trie may hold any part of the list: what a vocabulary finds is a set of hits that :func:`options` weighs once all
parts have been asked, and what phrases find has a place in one order of preference for the whole list.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

from timeloom.llm.lookalike import CYRILLIC, CYRILLIC_AS, GREEK, GREEK_AS
from timeloom.llm.trie import Trie

# Letters that a reader takes for each other (a misreading counts half an edit), and letter pairs
# taken for one letter.
CONFUSED = "o0 oc oa oe ec ea ac l1 i1 il it lt tf tl s5 b8 bh hn nr nu uv gq g9 g6 yv z2 b6 ij"
PAIRS_FOR_ONE = {"rn": "m", "cl": "d", "vv": "w"}
DIGIT_AS_LETTER = str.maketrans("01586", "olsbb")

_SAME = str.maketrans(CYRILLIC + GREEK, CYRILLIC_AS + GREEK_AS)
_WORD = re.compile(r"[^\W_]+")
_CLOSE = {c: "".join(p.replace(c, "", 1) for p in CONFUSED.split() if c in p) for c in set(CONFUSED) - {" "}}
_VOWELS = re.compile(r"(?<=.)[aeiou]")


@dataclass(frozen=True)
class Surroundings:
    """What may stand around a name without being part of it; a pattern of None takes nothing for surroundings.

    ``number``: a number at the end, with the signs around it. ``word``: a sign and a word before that number.
    ``cut``: how a name ends that was cut off.
    """

    number: str | None = r"[\s\[<(#|—:]*\d{4,}[\s\W_]*$"
    word: str | None = r"\s*(?:[—|:(]|\s[–-])\s*[^\W_]+[\s\W_]*$"
    cut: str | None = r"(\.\.+|…)[\s\W_]*$"


def fold(text: str) -> str:
    """Letters of one alphabet, without accents and case."""
    text = unicodedata.normalize("NFKD", text)
    if not text.isascii():
        text = "".join(c for c in text if not unicodedata.combining(c)).translate(_SAME)
    return text.casefold()


def words_of(text: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(fold(text)))


def as_letters(word: str) -> str:
    """A word with digits read as the letters they are taken for; numbers stay."""
    return word if word.isdigit() or word.isalpha() else word.translate(DIGIT_AS_LETTER)


def split_digits(words: Iterable[str]) -> tuple[str, ...]:
    """Words with numbers that were run together with them set apart."""
    return tuple(p for w in words for p in re.findall(r"\d+|\D+", w))


def one_for_pair(word: str) -> str:
    for pair, one in PAIRS_FOR_ONE.items():
        word = word.replace(pair, one)
    return word


def misreading(a: str, b: str, most: int) -> int:
    """Distance in half edits (a confused letter 1, any other edit or swap of neighbours 2); ``most`` + 1 if above.

    Only the places within reach of the diagonal are kept, so the work grows with the length and not with its square.
    """
    if a == b:
        return 0
    size, reach, far = len(b), most // 2, most + 1
    if abs(len(a) - size) > reach:
        return far
    width = 2 * reach + 1  # place k of a row stands for letter k - reach + (its number) of b
    before, row, low = None, [2 * (k - reach) if 0 <= k - reach <= size else far for k in range(width)], 0
    for i, c in enumerate(a, 1):
        close = _CLOSE.get(c, "")
        following, least = [far] * width, far
        for k in range(max(0, reach - i), min(width, size - i + reach + 1)):
            j = i + k - reach
            if j == 0:
                best = 2 * i
            else:
                y = b[j - 1]
                best = row[k] + (0 if c == y else 1 if y in close else 2)
                if k + 1 < width and row[k + 1] + 2 < best:
                    best = row[k + 1] + 2
                if k and following[k - 1] + 2 < best:
                    best = following[k - 1] + 2
                if before is not None and j > 1 and c == b[j - 2] and a[i - 2] == y and before[k] + 2 < best:
                    best = before[k] + 2
            following[k] = best
            if best < least:
                least = best
        if least > most and low > most:
            return far
        before, row, low = row, following, least
    return min(row[size - len(a) + reach], far)


def allowed(length: int) -> int:
    """Half edits allowed in a word of this length."""
    return 0 if length < 3 else 2 if length < 5 else 3 if length < 6 else 4 if length < 8 else 5 if length < 10 else 6


LONG = 300  # longer names are not kept in caches


def word_distance(a: str, b: str) -> int:
    """Misreading distance of two words in half edits, or -1 where they are different words or numbers."""
    return _word_distance(a, b) if len(a) + len(b) <= LONG else _word_distance.__wrapped__(a, b)


@lru_cache(maxsize=1 << 16)
def _word_distance(a: str, b: str) -> int:
    if a == b:
        return 0
    if a.isdigit() or b.isdigit():
        return -1
    a, b = as_letters(a), as_letters(b)
    longer = max(len(a), len(b))
    most = 4 if longer == 5 else allowed(longer)  # both may be misread
    found = min(misreading(a, b, most), misreading(one_for_pair(a), one_for_pair(b), most - 1) + 1)
    return found if found <= most else -1


def _same_words(a: tuple[str, ...], b: tuple[str, ...], most: int) -> bool:
    if len(a) == len(b):
        total = 0
        for x, y in zip(a, b, strict=True):
            d = word_distance(x, y)
            if d < 0:
                break
            total += d
        else:
            return total <= most
    numbers = [w for w in a if w.isdigit()], [w for w in b if w.isdigit()]
    if numbers[0] != numbers[1]:
        return False
    x, y = "".join(map(as_letters, a)), "".join(map(as_letters, b))
    few = min(4, len(x) // 6 * 2)
    return misreading(x, y, few) <= few if len(a) != len(b) else False


def same_heading(a: str, b: str, most: int = 10) -> bool:
    """Whether two names are one heading apart from formatting, accents and a few misread letters."""
    return _same_heading(a, b, most) if len(a) + len(b) <= LONG else _same_heading.__wrapped__(a, b, most)


@lru_cache(maxsize=1 << 16)
def _same_heading(a: str, b: str, most: int) -> bool:
    x, y = words_of(a), words_of(b)
    if not x or not y:
        return False
    if x == y or "".join(x) == "".join(y):
        return True
    if _same_words(x, y, most):
        return True
    s, t = split_digits(x), split_digits(y)
    return (s != x or t != y) and _same_words(s, t, most)


def abbreviations(word: str) -> Iterator[str]:
    """Alias paths of a word: cut to four or five letters, and without its inner vowels."""
    if len(word) > 4:
        yield word[:4]
    if len(word) > 5:
        yield word[:5]
        bare = _VOWELS.sub("", word)
        if 2 < len(bare) < len(word):
            yield bare


def spoken(name: str, around: Surroundings = Surroundings()) -> str:
    """A name as it is searched for: its words, then (after ``|``) its words without what surrounds them; a last ``…``
    where it was cut off. Empty where it has no words."""
    tried = [name]
    if around.number and (bare := re.sub(around.number, "", name)) != name:
        tried += [bare, re.sub(around.word, "", bare)] if around.word else [bare]
    said = list(dict.fromkeys(" ".join(w) for text in tried if (w := words_of(text))))
    if said and around.cut and re.search(around.cut, name):
        said.append("…")
    return "|".join(said)


@lru_cache(maxsize=1 << 14)
def forms_of(said: str) -> tuple[tuple[tuple[str, ...], ...], tuple[tuple[str, ...], ...], str | None]:
    """Of a result of :func:`spoken`: its variants, its forms (variants, and each with its digits set apart), and the
    letters of the whole name where it was cut off."""
    parts = [tuple(p.split()) for p in said.split("|")] if said else []
    begun = "".join(parts[0]) if parts and parts[-1] == ("…",) else None
    variants = tuple(p for p in parts if p != ("…",))
    return variants, tuple(f for words in variants for f in dict.fromkeys((words, split_digits(words)))), begun


def allowed_badly(length: int) -> int:
    """Half edits allowed in the one word of a name that may be misread badly."""
    return 6 if length > 7 else 4 if length == 5 else allowed(length)


@lru_cache(maxsize=None)
def farthest(length: int) -> int:
    """Half edits allowed in the one badly misread word at most, if this many letters of it are read (few of them missing)."""
    return max(allowed_badly(n) for n in range(length, length + 4) if 2 * (n - length) <= allowed_badly(n))


KNOWN, FULL, SHORT, BEGUN, FULL_BADLY, SHORT_BADLY = range(6)
Hit = tuple[int, str, int]  # kind, reference word, cost


class Vocabulary:
    """A part of the words of the reference list: a trie of words with their abbreviations as alias paths."""

    def __init__(self, words: Iterable[str]) -> None:
        self.known = frozenset(words)
        self.trie = Trie(_CLOSE)
        for w in self.known:
            self.trie.add(w, (w, 0))
            for short in abbreviations(w):
                self.trie.add(short, (w, 2))

    def search(self, words: list[str]) -> dict[str, list[Hit]]:
        """All hits of each word: itself, words and abbreviations near it, words that begin with it or nearly so."""
        hits: dict[str, dict[tuple[int, str], int]] = {w: {} for w in words}
        longest = max(map(len, self.known), default=0)

        def note(word: str, kind: int, reference: str, cost: int) -> None:
            held = hits[word]
            held[kind, reference] = min(cost, held.get((kind, reference), cost))

        near = defaultdict(list)  # allowed distance -> (word, letters searched for, cost of reading them so)
        begins = defaultdict(list)
        for word in hits:
            plain = as_letters(word)
            if word.isdigit() or len(plain) > longest + 4:
                continue
            if plain in self.known:
                note(word, KNOWN, plain, 0)
            if plain not in self.known or not allowed(len(plain)):
                for text, extra in ((plain, 0), (one_for_pair(plain), 1)):
                    if not extra or text != plain or any(p in plain for p in PAIRS_FOR_ONE.values()):
                        near[farthest(len(text))].append((word, text, extra))
            if len(plain) > 3:
                low, high = self.trie.continued(plain)
                for s in self.trie.strings[low:high]:
                    if len(s) > len(plain) and s in self.known:  # cut at the end: longer than an abbreviation
                        note(word, BEGUN, s, 2)
                if len(plain) > 4:
                    begins[2 if len(plain) < 6 else 3].append((word, plain))
        for most, asked in near.items():
            at, strings, distances = self.trie.within_many([text for _, text, _ in asked], most)
            for a, s, d in zip(at.tolist(), strings.tolist(), distances.tolist(), strict=True):
                word, text, extra = asked[a]
                path = self.trie.strings[s]
                for w, shortened in self.trie.held[path]:
                    few = min(2, allowed(len(path)))
                    if d <= (few if shortened else allowed(len(path))) and d <= allowed(len(text) + 2):
                        note(word, SHORT if shortened else FULL, w, d + extra + shortened)
                    if d <= (few if shortened else allowed_badly(len(path))):
                        note(word, SHORT_BADLY if shortened else FULL_BADLY, w, d + extra + shortened)
        for most, cut in begins.items():
            for a, low, high, d in self.trie.begun_many([plain for _, plain in cut], most):
                word, plain = cut[a]
                for s in self.trie.strings[low:high]:
                    if len(s) > len(plain) and s in self.known:
                        note(word, BEGUN, s, 2 + d)
        return {word: [(kind, w, cost) for (kind, w), cost in held.items()] for word, held in hits.items()}


def options(word: str, hits: Iterable[Hit], badly: bool = False) -> dict[str, int]:
    """All reference words that ``word`` may be, each with its cost, once all parts of the vocabulary were asked: every word
    within the allowed distance, however near another is. A known word is another word and never a misreading, unless it is
    too short to be told from a piece of another."""
    if word.isdigit():
        return {word: 0}
    by_kind: dict[int, dict[str, int]] = defaultdict(dict)
    for kind, w, cost in hits:
        by_kind[kind][w] = min(cost, by_kind[kind].get(w, cost))
    found = dict(by_kind[KNOWN])
    if not found or not allowed(len(as_letters(word))):
        found = by_kind[SHORT_BADLY if badly else SHORT] | found
        for w, cost in by_kind[FULL_BADLY if badly else FULL].items():
            found[w] = min(cost, found.get(w, cost))
    for w, cost in by_kind[BEGUN].items():
        found.setdefault(w, cost)
    return found


# The order of searches; a find of an earlier one is preferred to all of later ones, whatever they cost.
EXACT, WALKED, JOINED, BADLY, CONTINUED = range(5)
PLACES = 1_000  # places of one search: forms, exact and continued ends


class Phrases:
    """A part of the entries of the reference list: names as phrases of words, and as one string each."""

    def __init__(self, names: Iterable[tuple[int, tuple[str, ...]]] = ()) -> None:
        self.whole = Trie(_CLOSE)
        self.phrases: dict = {}
        self.exact: dict[str, set[int]] = defaultdict(set)
        for entry, words in names:
            text = "".join(words)
            self.exact[text].add(entry)
            self.whole.add(text, (entry, len(words)))
            for turn in range(len(words)):
                node = self.phrases
                for w in words[turn:] + words[:turn]:
                    node = node.setdefault(w, {})
                node.setdefault("", []).append((turn > 0, entry))

    def find(self, asked: dict[str, dict[str, list[Hit]]], every: bool = False) -> Iterator[tuple[str, int, int, int]]:
        """(said, place, cost, entry) of all entries within reach by the first search that finds any. ``asked``: results of
        :func:`spoken`, each with the hits of its words in the whole vocabulary. Of several entries that continue a name that
        was cut off, the least and the greatest (which tell that none is meant) unless ``every`` one is wanted."""
        open_: list[str] = []
        for said, hits in asked.items():
            variants, forms, _ = forms_of(said)
            found = next(([(EXACT * PLACES + i, 0, e) for e in self.exact[text]] for i, text in enumerate(map("".join, variants)) if text in self.exact), None)
            found = found or self._first(WALKED, forms, hits)
            if found:
                yield from ((said, *f) for f in found)
            else:
                open_.append(said)
        joined = self._joined(open_)
        for said in open_:
            _, forms, begun = forms_of(said)
            found = joined.get(said) or self._first(BADLY, forms, asked[said])
            if not found and begun is not None:
                found = [(CONTINUED * PLACES, 12, e) for e in self._begun(begun, every)]
            yield from ((said, *f) for f in found)

    def _first(self, search: int, forms: tuple[tuple[str, ...], ...], hits: dict[str, list[Hit]]) -> list[tuple[int, int, int]]:
        for i, form in enumerate(forms):
            for place, ends in enumerate(self._walk(form, hits, search == BADLY)):
                if ends:
                    return [(search * PLACES + 2 * i + place, c, e) for e, c in ends.items()]
        return []

    def _walk(self, words: tuple[str, ...], hits: dict[str, list[Hit]], badly: bool) -> Iterator[dict[int, int]]:
        """Entries reachable by ``words``, each with its least cost. The last word may be cut anywhere; ``badly``: one word
        may be misread badly; and then again: a short word may be missing at the end."""
        states = [(self.phrases, 0, False)]
        for i, w in enumerate(words):
            likely = options(w, hits.get(w, ()))
            following = [(node[o], cost + c, used) for node, cost, used in states for o, c in likely.items() if o in node]
            if badly:
                more = options(w, hits.get(w, ()), True)
                following += [(node[o], cost + c, True) for node, cost, used in states if not used for o, c in more.items() if o in node and o not in likely]
            if i == len(words) - 1 and i and w.isalpha():
                following += [(child, cost + 3, used) for node, cost, used in states for o, child in node.items() if o and o not in likely and o.startswith(w)]
            states = following
            if not states:
                return
        yield self._ends([(node, cost) for node, cost, _ in states])
        if badly:
            yield self._ends([(child, cost + 4) for node, cost, _ in states for o, child in node.items() if o and len(o) <= 3 and not o.isdigit()])

    @staticmethod
    def _ends(states: list[tuple[dict, int]]) -> dict[int, int]:
        found: dict[int, int] = {}
        for node, cost in states:
            for turned, entry in node.get("", ()):
                c = 2 * cost + turned
                found[entry] = min(c, found.get(entry, c))
        return found

    def _joined(self, asked: list[str]) -> dict[str, list[tuple[int, int, int]]]:
        """Entries near the words written as one, with the same numbers in them, but divided otherwise."""
        longest = max(map(len, self.exact), default=0)
        texts = defaultdict(list)
        for said in asked:
            for i, form in enumerate(forms_of(said)[1]):
                text = "".join(map(as_letters, form))
                if len(text) <= longest + 4:
                    texts[min(4, len(text) // 6 * 2)].append((said, i, len(form), text))
        found: dict[str, dict[tuple[int, int], int]] = defaultdict(dict)
        for most, rows in texts.items():
            at, strings, distances = self.whole.within_many([r[3] for r in rows], most)
            for a, s, d in zip(at.tolist(), strings.tolist(), distances.tolist(), strict=True):
                said, i, parts, text = rows[a]
                path = self.whole.strings[s]
                if re.findall(r"\d+", path) == re.findall(r"\d+", text):
                    for entry, n in self.whole.held[path]:
                        if n != parts:  # else the words themselves are not near enough
                            held = found[said]
                            held[i, entry] = min(2 * d, held.get((i, entry), 2 * d))
        best = {said: min(i for i, _ in held) for said, held in found.items()}
        return {said: [(JOINED * PLACES + i, c, e) for (i, e), c in held.items() if i == best[said]] for said, held in found.items()}

    def _begun(self, letters: str, every: bool) -> list[int]:
        """The entries that begin with these letters, or the least and the greatest of them."""
        low, high = self.whole.continued(letters)
        found = {e for s in self.whole.strings[low:high] for e, _ in self.whole.held[s]}
        return sorted(found if every or not found else {min(found), max(found)})


def chosen(found: Iterable[tuple[int, int, int]]) -> tuple[int, int] | None:
    """(cost, entry) of (place, cost, entry) over the whole list: the first place, then the nearest, then the smallest entry;
    None where a name that was cut off may be continued by several."""
    found = list(found)
    if not found:
        return None
    place, cost, entry = min(found)
    return None if place >= CONTINUED * PLACES and len({e for _, _, e in found}) > 1 else (cost, entry)


class ReferenceList(Phrases):
    """A list small enough for one task; ``entries``: (entry, label, aliases)."""

    def __init__(self, entries: Iterable[tuple[int, str, Iterable[str]]]) -> None:
        names = [(entry, words) for entry, label, aliases in entries for name in (label, *aliases) if (words := words_of(name))]
        super().__init__(names)
        self.vocabulary = Vocabulary({w for _, words in names for w in words if not w.isdigit()})

    def match(self, name: str, around: Surroundings = Surroundings()) -> int:
        """The entry ``name`` stands for, or -1."""
        said = spoken(name, around)
        hits = self.vocabulary.search([w for form in forms_of(said)[1] for w in form])
        best = chosen(f[1:] for f in self.find({said: hits})) if said else None
        return best[1] if best else -1
