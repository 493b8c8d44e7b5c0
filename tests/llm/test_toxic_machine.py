"""The composed grammar against an enumeration of all paths through its parts."""

import random

from flowgraph.llm import toxicity


def enumerated(grammar, tokens):
    """Patterns and their best weight, by following every reading of every word through every part in turn."""
    parts = toxicity.cascade()
    paths = [([p.start for p in parts], 1.0)]
    for word in tokens:
        if not grammar.readings(word):
            continue
        ahead = []
        for states, weight in paths:
            for symbol, sure in grammar.readings(word):
                partial = [(symbol, weight, [])]
                for part, state in zip(parts, states):
                    partial = [(out, v * w, done + [to]) for mid, v, done in partial for out, w, to in part.step(state, mid)]
                ahead += [(done, v * (sure if out in toxicity.PRIORS else 1.0)) for out, v, done in partial]
        paths = ahead
    best = {}
    for states, weight in paths:
        if all(s in p.final for s, p in zip(states, parts)):
            best[states[-1]] = max(weight, best.get(states[-1], 0.0))
    return best


def test_machine_agrees_with_all_paths():
    rng = random.Random(3)
    # 'sie' is also an insult here and 'burn' also a report, so words have several readings
    g = toxicity.Grammar(insults={"scum": 0.7, "sie": 0.2, "idiot": 0.9}, stems={"lowe": 0.4})
    words = "scum idiot sie loweing clown you te dich not said kill burn table they never wrote".split()
    for _ in range(300):
        tokens = [rng.choice(words) for _ in range(rng.randint(0, 7))]
        want, got = enumerated(g, tokens), dict(g.clause(tokens))
        assert set(got) == set(want), tokens
        assert all(abs(got[k] - want[k]) < 1e-12 for k in want), tokens


def test_threats_with_their_object_in_front():
    g = toxicity.Grammar()
    for text in ("Ich werde dich töten", "te voy a matar", "I will kill you"):
        assert g.clause(text.lower().split()) == [("threat", 0.9)] and g.score(text) >= toxicity.THRESHOLD
    assert g.clause("they beat the record".split()) == []
    assert g.clause("i will not kill you".split()) == [("negated threat", 0.9)]
    assert g.clause("anna said i will kill you".split()) == [("reported threat", 0.9)]


def test_doubtful_words():
    g = toxicity.Grammar()
    assert all(g.score(t) < toxicity.THRESHOLD for t in ("the clown fish", "a dumb terminal", "take out the trash"))
    assert all(g.score(t) >= toxicity.THRESHOLD for t in ("you clown", "you are so dumb"))


def test_a_skipped_match_costs_nothing():
    g = toxicity.Grammar(insults={"scum": 0.1, "idiot": 0.9})
    assert dict(g.clause("scum idiot kill you".split())) == {"insult": 0.9, "threat": 0.9}


def test_the_machine_is_small():
    assert len(toxicity.machine().arcs) < 1500
