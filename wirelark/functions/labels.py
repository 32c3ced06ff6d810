"""How far a label is from SUBJECT or SUBJ (F22): an automaton that reads a label once, letter by letter."""

from __future__ import annotations

from functools import lru_cache

WORDS = ("SUBJECT", "SUBJ")
#: Labels further off than this are all alike.
FAR = 5


@lru_cache(maxsize=1 << 18)
def edits(a: str, b: str) -> int:
    """Fewest letters put in, taken out or replaced, or neighbours exchanged, that turn one word into the other."""
    if not a or not b:
        return len(a) + len(b)
    if a[0] == b[0]:
        return edits(a[1:], b[1:])
    ways = [edits(a[1:], b), edits(a, b[1:]), edits(a[1:], b[1:])]
    if len(a) > 1 and a[:2] == b[1::-1]:
        ways.append(edits(a[2:], b[2:]))
    return 1 + min(ways)


class LabelAutomaton:
    """Edits between what was read and the nearest of some words; two neighbours exchanged, and nothing else, are one.

    A state has, for each word, the edits to each of its beginnings (``far`` at most) and the places a reader could be at
    that allows one exchange alone. States are numbered as they are first met; there are finitely many.
    """

    def __init__(self, words: tuple[str, ...] = WORDS, far: int = FAR):
        self.words, self.far = words, far
        self.letters = frozenset("".join(words))
        first = tuple((tuple(min(i, far) for i in range(len(w) + 1)), frozenset({(0, "before")})) for w in words)
        self.states, self.number, self.moves, self.told = [first], {first: 0}, {}, {}

    def _after(self, state: tuple, letter: str) -> tuple:
        out = []
        for word, (row, places) in zip(self.words, state, strict=True):
            new = [min(row[0] + 1, self.far)]
            for i, own in enumerate(word):
                new.append(min(new[i] + 1, row[i + 1] + 1, row[i] + (own != letter), self.far))
            moved = set()
            for at, phase in places:
                if phase == "within":  # the second letter came first: now the first one
                    moved |= {(at + 2, "behind")} if word[at] == letter else set()
                    continue
                if at < len(word) and word[at] == letter:
                    moved.add((at + 1, phase))
                if phase == "before" and at + 1 < len(word) and word[at + 1] == letter != word[at]:
                    moved.add((at, "within"))
            out.append((tuple(new), frozenset(moved)))
        return tuple(out)

    def step(self, state: int, letter: str) -> int:
        """The state behind a letter; letters of no word are all alike."""
        key = state, letter if letter in self.letters else ""
        if key not in self.moves:
            after = self._after(self.states[state], key[1])
            if after not in self.number:
                self.number[after] = len(self.states)
                self.states.append(after)
            self.moves[key] = self.number[after]
        return self.moves[key]

    def distance(self, label: str) -> int:
        state = 0
        for letter in label:
            state = self.step(state, letter)
        if state not in self.told:
            ends = [1 if (len(w), "behind") in places else row[-1] for w, (row, places) in zip(self.words, self.states[state], strict=True)]
            self.told[state] = min(ends)
        return self.told[state]


_SUBJECT = LabelAutomaton()


def label_tier(label: str) -> int:
    """Edits from SUBJECT or SUBJ, blanks aside; ``FAR`` for all that are further off."""
    return _SUBJECT.distance("".join(label.upper().split()))
