"""Prose and tables the tests of the training-data operators are made from."""

import random

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


STEMS = (
    "water stone house light river field winter summer garden market paper silver bridge forest mountain letter window "
    "music island harbor morning evening village castle engine flower animal planet doctor teacher").split()


def prose(rng: random.Random, n: int, vocabulary: int = 900) -> str:
    words = [a + b for a in STEMS for b in STEMS][:vocabulary]
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."
