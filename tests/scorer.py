"""The sentiment rules once more, straight from their description, one text at a time."""

import math
import re

from galewatch.functions import wordlists

MARKS = [".", "!", "?", ",", ";", ":", "-", "'", '"', "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?"]
BOOSTS = dict.fromkeys(wordlists.INTENSIFIERS, 0.293) | dict.fromkeys(wordlists.DAMPENERS, -0.293)
PUNCTUATION = set("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def bare(token):
    if not PUNCTUATION & {token[0], token[-1]}:
        return token
    for mark in MARKS:
        after = token[len(mark) :] if token.startswith(mark) else ""
        before = token[: -len(mark)] if token.endswith(mark) else ""
        for rest in (after, before):
            if len(rest) > 1 and not PUNCTUATION & set(rest):
                return rest
    return token


def negated(token):
    return token.lower() in wordlists.NEGATIONS or "n't" in token.lower()


def score(text, lexicon):
    tokens = [bare(token) for token in re.split(r"\s+", text) if len(token) > 1]
    emphatic = any(token.isupper() for token in tokens) and not all(token.isupper() for token in tokens)
    valences = [valence_at(tokens, i, lexicon, emphatic) for i in range(len(tokens))]
    lowered = [token.lower() for token in tokens]
    if "but" in lowered:
        turn = lowered.index("but")
        valences = [v * (0.5 if i < turn else 1.5 if i > turn else 1) for i, v in enumerate(valences)]
    total = sum(valences)
    marks = min(text.count("!"), 4) * 0.292
    questions = text.count("?")
    if questions > 1:
        marks += questions * 0.18 if questions <= 3 else 0.96
    total += marks if total > 0 else -marks if total < 0 else 0
    return round(total / math.sqrt(total * total + 15), 4)


def valence_at(tokens, i, lexicon, emphatic):
    token = tokens[i]
    low = token.lower()
    if low in BOOSTS or low not in lexicon:
        return 0.0
    if low == "kind" and i + 1 < len(tokens) and tokens[i + 1].lower() == "of":
        return 0.0
    v = lexicon[low]
    if emphatic and token.isupper():
        v += 0.733 if v > 0 else -0.733
    for back, damping in ((1, 1.0), (2, 0.95), (3, 0.9)):
        if i < back:
            break
        prev = tokens[i - back]
        if prev.lower() in lexicon:
            continue
        if prev.lower() in BOOSTS:
            change = BOOSTS[prev.lower()] * (-1 if v < 0 else 1)
            if emphatic and prev.isupper():
                change += 0.733 if v > 0 else -0.733
            v += change * damping
        after = tokens[i - back + 1 : i]
        if back == 2 and prev == "never" and after[0] in ("so", "this"):
            v *= 1.5
        elif back == 3 and ((prev == "never" and after[0] in ("so", "this")) or after[1] in ("so", "this")):
            v *= 1.25
        elif negated(prev):
            v *= -0.74
    if i >= 3 and tokens[i - 3].lower() not in lexicon:
        v = idiom_at(tokens, i, v)
    if i >= 1 and tokens[i - 1].lower() == "least" and "least" not in lexicon and (i < 2 or tokens[i - 2].lower() not in ("at", "very")):
        v *= -0.74
    return v


def idiom_at(tokens, i, v):
    ranges = [(i - 1, i + 1), (i - 2, i + 1), (i - 2, i), (i - 3, i), (i - 3, i - 1)]
    for start, end in ranges:
        phrase = " ".join(tokens[start:end])
        if phrase in wordlists.IDIOMS:
            v = wordlists.IDIOMS[phrase]
            break
    for end in (i + 2, i + 3):
        if end <= len(tokens):
            v = wordlists.IDIOMS.get(" ".join(tokens[i:end]), v)
    if {" ".join(tokens[i - 3 : i - 1]), " ".join(tokens[i - 2 : i])} & wordlists.DAMPENING_PHRASES:
        v -= 0.293
    return v
