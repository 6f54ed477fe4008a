r"""Wrappers of hosts: simple tree matching of pages with their host's pivot, and verdicts on its slots.

The pivot of a host is one of its pages, of middling size; its nodes are the slots. A page is
matched with the pivot: roots must have one label, and the children of matched nodes are aligned in
order for the largest number of matched nodes below them. That is the whole program, without
bounds on width or depth: subtrees of one shape are scored once, long lists of children
are aligned row by row in numpy, and very long ones by halves, so memory is linear in their length.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from .dom import DROP, LANDMARK, PROSE_TAG, parents

#: Alignments of more cells than this are traced by halves.
TRACED_CELLS = 1 << 20
OUTSIDE, PATH, CONTENT = 0, 1, 2


class Shapes:
    """Interned subtree shapes (label, shapes of the children) and the scores of pairs of them."""

    def __init__(self, most: int = 200_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.label: list[int] = []
        self.kids: list[tuple[int, ...]] = []
        self.nodes: list[int] = []
        self.by_label: list[dict[int, list[int]]] = []  # distinct shapes of the children by label
        self.scores: dict[tuple[int, int], int] = {}

    def of(self, label: list[int], kids: list[list[int]]) -> list[int]:
        """Shape of each node of a tree in page order."""
        out = [0] * len(label)
        for i in range(len(label) - 1, -1, -1):
            key = (label[i], tuple([out[c] for c in kids[i]]))
            if (known := self.ids.get(key)) is None:
                known = self.ids[key] = len(self.label)
                self.label.append(label[i])
                self.kids.append(key[1])
                self.nodes.append(1 + sum(self.nodes[c] for c in key[1]))
                groups: dict[int, list[int]] = {}
                for c in set(key[1]):
                    groups.setdefault(self.label[c], []).append(c)
                self.by_label.append(groups)
            out[i] = known
        return out

    def score(self, a: int, b: int) -> int:
        """Nodes that simple tree matching pairs in two subtrees."""
        if a == b:
            return self.nodes[a]
        if self.label[a] != self.label[b]:
            return 0
        todo = [(a, b)]
        while todo:
            x, y = todo[-1]
            if (x, y) in self.scores:
                todo.pop()
                continue
            theirs = self.by_label[y]
            need = [(p, q) for at, ps in self.by_label[x].items() if at in theirs for p in ps for q in theirs[at] if p != q and (p, q) not in self.scores]
            if need:
                todo.extend(need)
                continue
            self.scores[x, y] = 1 + self.value(self.kids[x], self.kids[y])
            todo.pop()
        return self.scores[a, b]

    def known(self, p: int, q: int) -> int:
        return self.nodes[p] if p == q else self.scores.get((p, q), 0)

    def weights(self, x: tuple[int, ...], y: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(row of each of x, scores of each distinct one of x with all of y)."""
        first, row = np.unique(x, return_inverse=True)
        kinds, column = np.unique(y, return_inverse=True)
        table = np.array([[self.known(p, q) for q in kinds.tolist()] for p in first.tolist()], np.int32)
        return row, table[:, column]

    def value(self, x: tuple[int, ...], y: tuple[int, ...]) -> int:
        """The best alignment's score; scores of the pairs are known."""
        low, end = ends(x, y)
        total = sum(self.nodes[p] for p in x[:low]) + sum(self.nodes[p] for p in x[len(x) - end :])
        x, y = x[low : len(x) - end], y[low : len(y) - end]
        if not x or not y:
            return total
        return total + int(last_row(*self.weights(x, y))[-1])

    def align(self, x: list[int], y: list[int]) -> list[tuple[int, int]]:
        """Places (in x, in y) of the best alignment's pairs; scores of the pairs are worked out first."""
        for p in set(x):
            for q in set(y):
                self.score(p, q)
        low, end = ends(x, y)
        pairs = [(i, i) for i in range(low)] + [(len(x) - k, len(y) - k) for k in range(1, end + 1)]
        todo = [(low, len(x) - end, low, len(y) - end)]
        while todo:
            a, b, c, d = todo.pop()
            if a == b or c == d:
                continue
            row, table = self.weights(tuple(x[a:b]), tuple(y[c:d]))
            if (b - a) * (d - c) <= TRACED_CELLS or b - a == 1:
                pairs += [(a + i, c + j) for i, j in traced(row, table)]
                continue
            half = (b - a) // 2
            before = last_row(row[:half], table)
            after = last_row(row[half:][::-1], table[:, ::-1])[::-1]
            cut = int((before + after).argmax())
            todo += [(a, a + half, c, c + cut), (a + half, b, c + cut, d)]
        return pairs


def ends(x: list[int], y: list[int]) -> tuple[int, int]:
    """Equal shapes at both ends; to pair these is always best."""
    low, high = 0, min(len(x), len(y))
    while low < high and x[low] == y[low]:
        low += 1
    end = 0
    while low + end < high and x[-1 - end] == y[-1 - end]:
        end += 1
    return low, end


def last_row(row: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Best scores of all of x with each beginning of y."""
    best = np.zeros(table.shape[1] + 1, np.int64)
    for r in row:
        best[1:] = np.maximum(best[1:], best[:-1] + table[r])
        np.maximum.accumulate(best, out=best)
    return best


def traced(row: np.ndarray, table: np.ndarray) -> list[tuple[int, int]]:
    best = np.zeros((len(row) + 1, table.shape[1] + 1), np.int32)
    for i, r in enumerate(row):
        best[i + 1, 1:] = np.maximum(best[i, 1:], best[i, :-1] + table[r])
        np.maximum.accumulate(best[i + 1], out=best[i + 1])
    pairs, i, j = [], len(row), table.shape[1]
    while i and j:
        if best[i, j] == best[i, j - 1]:
            j -= 1
        elif best[i, j] == best[i - 1, j]:
            i -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs


@dataclass
class Tree:
    """A page's nodes as lists."""

    label: list[int]
    up: list[int]
    kids: list[list[int]] = field(init=False)

    def __post_init__(self) -> None:
        self.kids = [[] for _ in self.label]
        for i, p in enumerate(self.up):
            if p >= 0:
                self.kids[p].append(i)


def tree(depth: np.ndarray, label: np.ndarray) -> Tree:
    return Tree(label.tolist(), parents(depth.tolist()))


def match(page: Tree, pivot: Tree, shapes: Shapes, pivot_shapes: list[int]) -> list[int]:
    """Slot (node of the pivot) of each node of a page, -1 without one."""
    own = shapes.of(page.label, page.kids)
    slots = [-1] * len(own)
    todo = [(0, 0)] if page.label and pivot.label and page.label[0] == pivot.label[0] else []
    while todo:
        i, j = todo.pop()
        slots[i] = j
        x, y = page.kids[i], pivot.kids[j]
        if x and y:
            todo += [(x[p], y[q]) for p, q in shapes.align([own[c] for c in x], [pivot_shapes[c] for c in y])]
    return slots


class Matcher:
    """Matches pages with one host's pivot after another's."""

    def __init__(self):
        self.shapes, self.key, self.pivot, self.of = Shapes(), None, None, []

    def __call__(self, host: str, depth: bytes, label: bytes, page: Tree) -> list[int]:
        if host != self.key or len(self.shapes.label) + len(self.shapes.scores) > self.shapes.most:
            self.shapes.clear()
            self.key, self.pivot = host, tree(np.frombuffer(depth, np.uint32), np.frombuffer(label, np.uint32))
            self.of = self.shapes.of(self.pivot.label, self.pivot.kids)
        return match(page, self.pivot, self.shapes, self.of)


@dataclass(frozen=True)
class Judge:
    #: A slot is constant if so large a share of pairs of pages, and so many at least, had equal text there.
    constant_share: float = 0.8
    min_pairs: int = 4
    #: The main slot is sought downwards while one child has this share of the varying text ...
    main_share: float = 0.5
    #: ... and no other child more than this part of that child's.
    rival_share: float = 0.25
    #: Outside the main slot, blocks of less than this part of its varying text are no content, nor are those mostly of links.
    beside_share: float = 0.1
    link_share: float = 0.5


def constant(same: np.ndarray, pairs: np.ndarray, how: Judge) -> np.ndarray:
    return (pairs >= how.min_pairs) & (same >= how.constant_share * pairs)


def verdicts(pivot: Tree, flags: np.ndarray, pages: int, fixed: np.ndarray, own: np.ndarray, link: np.ndarray, how: Judge) -> tuple[np.ndarray, float, bool]:
    """(OUTSIDE, PATH or CONTENT for each slot; mean varying characters of the main slot; whether landmarks alone are content).

    own, link: sums over the host's pages of the characters (and of those in links) that lay in the slot itself or in
    unmatched blocks below it.
    """
    n = len(pivot.label)
    alive = (flags & DROP) == 0
    vary = np.where(fixed | ~alive, 0.0, own / max(1, pages))
    linked = np.where(fixed | ~alive, 0.0, link / max(1, pages))
    below, below_link, solid = vary.copy(), linked.copy(), np.zeros(n, bool)
    for i in range(n - 1, 0, -1):
        if alive[i]:
            below[pivot.up[i]] += below[i]
            below_link[pivot.up[i]] += below_link[i]
    out = np.full(n, OUTSIDE, np.int8)
    marks = [i for i in range(n) if alive[i] and flags[i] & LANDMARK]
    main = 0
    while True:
        kids = sorted((c for c in pivot.kids[main] if alive[c]), key=lambda c: (-below[c], c))
        if not kids or below[kids[0]] < how.main_share * below[main] or below[kids[0]] == 0 or flags[kids[0]] & PROSE_TAG:
            break
        if flags[main] & LANDMARK or (len(kids) > 1 and below[kids[1]] > how.rival_share * below[kids[0]]):
            break
        main = kids[0]
    path = [main]
    while pivot.up[path[-1]] >= 0:
        path.append(pivot.up[path[-1]])
    # A landmark around the main slot is content as a whole, and then only landmarks are.
    if around := [i for i in path if flags[i] & LANDMARK and alive[i]]:
        main = around[-1]
    elif marks and sum(below[i] for i in marks) >= how.main_share * below[0]:
        main = -1
    solid[marks] = True
    if main >= 0:
        solid[main] = True
        if not flags[main] & LANDMARK:
            on_path = set(path)
            for a in path[1:]:
                for c in pivot.kids[a]:
                    if c in on_path or not alive[c]:
                        continue
                    enough = flags[c] & PROSE_TAG or below[c] >= how.beside_share * below[main]
                    solid[c] |= bool(enough and below[c] > 0 and below_link[c] <= how.link_share * below[c])
    for i in range(n):
        up = pivot.up[i]
        if alive[i] and (solid[i] or (up >= 0 and out[up] == CONTENT)):
            out[i] = CONTENT
    for i in range(n):
        if out[i] == CONTENT:
            at = pivot.up[i]
            while at >= 0 and out[at] == OUTSIDE:
                out[at] = PATH
                at = pivot.up[at]
    return out, float(below[main] if main >= 0 else below[0]), main < 0 or bool(flags[main] & LANDMARK)
