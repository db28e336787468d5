"""Plain Python versions that the operators are compared with."""

from __future__ import annotations

import re
import string

UPPER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def shingles(words, k):
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


class Union:
    """Components by union-find, named by their least member."""

    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
