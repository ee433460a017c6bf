"""Misspellings at the first letter, of short terms, and with signs at the edge."""

import random

from sourceground.llm import toxicity
from test_scores import distance


def test_whole_automaton_is_the_edit_distance():
    rng = random.Random(2)
    terms = ["idiot", "moron", "scum", "git", "worthless", "disgusting", "clown"]
    automaton = toxicity.Automaton(terms, whole=True)
    for _ in range(4000):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            w[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "o"])
        word = "".join(w)
        best = min(((d, t) for t in terms if (d := distance(word, t)) <= (2 if len(t) >= 9 else 1)), default=None)
        assert automaton.match(word) == (best[::-1] if best else None), word


def test_misspelled_terms_are_caught():
    model = toxicity.ToxicityModel({"idiot": 1.5, "stupid": 1.5, "scum": 1.5}, {}, frozenset({"scam"}))
    for word in ("odiot", "diot", "xstupid", "scvm", "scm", "$tupid", "!diot", "$cum!", "'$tupid'"):
        assert model._lookup(word), word
        assert model.score(f"you are {word}") > model.score("you are scam"), word
    for word in ("scam", "scam!", "plain", "$5", "!", "a!"):
        assert model._lookup(word) is None, word
