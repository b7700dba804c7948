"""Slow and simple versions of the operators."""

from __future__ import annotations

import hashlib
import re
import string
from collections import Counter, defaultdict

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, word characters, symbols, repeated lines and words in repeated windows of five."""
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    grams = [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
    counts = Counter(grams)
    inside = {j for i, g in enumerate(grams) if counts[g] > 1 for j in range(i, i + 5)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(inside)


def shingles(text: str | None, size: int) -> set[tuple[str, ...]]:
    found = words((text or "").translate(LOWER))
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} or {tuple(found)}


def components(docs: list[tuple[int, str | None]], size: int, above: int, below: int) -> dict[int, tuple[int, int]]:
    """Set size and least linked id of every document."""
    sets = [shingles(text, size) for _, text in docs]
    parent = list(range(len(docs)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    where = defaultdict(list)
    for i, found in enumerate(sets):
        shared = Counter(j for s in found for j in where[s])
        for j, n in shared.items():
            if below * n >= above * (len(found) + len(sets[j]) - n):
                parent[top(i)] = top(j)
        for s in found:
            where[s].append(i)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return {doc: (len(sets[i]), least[top(i)]) for i, (doc, _) in enumerate(docs)}


def near_lines(docs: list[tuple[int, str | None]], least: int = 5, edited: int = 8) -> dict[int, str | None]:
    """The texts that are left after lines went that have an equal or near one earlier."""

    def near(a: tuple, b: tuple) -> bool:
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1 or len(a) < edited:
            return False
        start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[start + (len(a) == len(b)) :] == b[start + 1 :]

    places: dict[tuple, tuple[int, int]] = {}
    kept, gone = defaultdict(list), defaultdict(set)
    for doc, text in sorted(docs, key=lambda d: d[0]):
        for i, line in enumerate((text or "").split("\n")):
            found = tuple(words(line.translate(LOWER)))
            if len(found) < least:
                continue
            if found in places or any(near(found, other) for n in (-1, 0, 1) for other in kept[len(found) + n]):
                gone[doc].add(i)
            if found not in places:
                places[found] = (doc, i)
                kept[len(found)].append(found)
    left = {}
    for doc, text in docs:
        if doc not in gone:
            left[doc] = text
            continue
        rest = "\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone[doc])
        if words(rest):
            left[doc] = rest
    return left


def shares(budget: int, children: dict[str, tuple[int, float]]) -> dict[str, int]:
    """The budget of each child (capacity, weight): full ones go out until the rest can take their shares."""
    found, open_ones, left = {}, dict(children), float(budget)
    while True:
        total = sum(weight for _, weight in open_ones.values())
        full = {name: c for name, (c, weight) in open_ones.items() if c * total <= left * weight}
        if not full:
            return found | {name: int(left * weight // total) for name, (_, weight) in open_ones.items()}
        found |= full
        left -= sum(full.values())
        open_ones = {name: child for name, child in open_ones.items() if name not in full}


def mixed(docs: list[tuple], weights: dict[str, int], total: int | None, max_epochs: int, seed: int) -> Counter:
    """Documents (id, text, three names) taken, as (id, epoch, tokens taken)."""

    def md5(text: str) -> str:
        return hashlib.md5(text.encode()).hexdigest()

    leaves = defaultdict(list)
    for doc, text, *path in docs:
        if words(text):
            leaves[tuple(name or "" for name in path)].append((doc, text, len(words(text))))
    supply = {path: sum(n for *_, n in leaf) for path, leaf in leaves.items()}
    budgets = {(): sum(supply.values()) if total is None else total}
    for depth in range(3):
        below = {}
        for parent, budget in budgets.items():
            children = defaultdict(int)
            for path in supply:
                if path[:depth] == parent:
                    children[path[depth]] += supply[path] * max_epochs
            weighed = {
                name: (c, float(weights.get("/".join((*parent, name)), weights.get(f"*/{name}", 1))))
                for name, c in children.items()
            }
            below |= {(*parent, name): share for name, share in shares(budget, weighed).items()}
        budgets = below
    taken = Counter()
    for path, leaf in leaves.items():
        epochs, rest = divmod(budgets[path], supply[path])
        taken.update((doc, epoch, n) for doc, _, n in leaf for epoch in range(epochs))
        for doc, text, n in sorted(leaf, key=lambda d: md5(f"{seed}:{epochs}:{d[0]}") + md5(d[1])):
            if rest <= 0:
                break
            taken[doc, epochs, min(rest, n)] += 1
            rest -= n
    return taken
