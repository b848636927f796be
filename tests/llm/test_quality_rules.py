from __future__ import annotations

import random
import re

from blockloom.llm import quality_rules


def brute(i, text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = {}
    for k in range(len(words) - 7):
        places.setdefault(tuple(words[k : k + 8]), []).append(k)
    again = {j for own in places.values() if len(own) > 1 for k in own for j in range(k, k + 8)}
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    return (str(i), len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed)


def test_base_measures(spark, docs):
    draw = random.Random(4)
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, "a " * 400), (5, "ä#b |\n\nä#b |\x0b\nä#b |"), (None, "x\x85y z " * 9), (6, "one\r\none\rone\none"), (6, "seven words here are not a window")]
    for k in range(7, 40):
        phrase = " ".join(draw.choices("abcdefgh", k=draw.randint(6, 12)))
        parts = [draw.choice([phrase, " ".join(draw.choices("abcdefghijklmnop€", k=draw.randint(1, 30)))]) for _ in range(draw.randint(1, 8))]
        rows.append((k, draw.choice(["\n", " "]).join(parts)))
    rows.append((90, " ".join(str(k % 5003) for k in range(30000))))
    got = [
        (str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in quality_rules.judge(docs(rows), carry=("lang", "n_words")).collect()
    ]
    assert sorted(got) == sorted(brute(i, t) for i, t in rows)


GOOD = "This is a sentence that says something, and goes on for a while.\nAnd then another one follows it here, in good order."
BAD = {
    "navigation": "Home | About | Contact | Imprint",
    "symbols": "thing*** other### thing%%% more&&& done",
    "shouting": "BUY NOW!! ONLY TODAY!! CHEAP!!",
    "stutter": "spam spam spam spam spam ham ham ham ham.",
    "unpunctuated": "word after word " * 5,
    "boilerplate": "We use cookies to serve you.",
}


def test_each_rule(spark, docs):
    names = list(BAD)
    rows = [(k, f"{GOOD}\n{BAD[name]}\n{GOOD[::-1]}, in. reverse. order.") for k, name in enumerate(names)] + [(99, GOOD), (100, "\n".join(BAD.values()) + "\n" + GOOD), (101, "x\n\n\n" + GOOD + "\n")]
    got = {r.doc_id: r for r in quality_rules.judge(docs(rows)).collect()}
    for k, name in enumerate(names):
        assert {x.rule: x.lines for x in got[k].n_failed} == {n: int(n == name) for n in names}
        assert got[k].cleaned_text == rows[k][1].replace(BAD[name] + "\n", "")
    assert got[99].kept and got[99].cleaned_text == GOOD and got[99].lost == 0
    assert not got[100].kept and got[100].cleaned_text == GOOD
    assert got[101].cleaned_text == rows[-1][1]


def test_empty(spark, docs):
    assert quality_rules.judge(docs([])).collect() == []
