"""Expectation-maximisation over the votes of overlapping labelers."""

from __future__ import annotations


def estimate(
    counts: dict[tuple[int, ...], int], rounds: int = 50, start: tuple[float, float, float] = (0.5, 0.8, 0.8)
) -> tuple[float, list[tuple[float, float]], dict[tuple[int, ...], float]]:
    """Fit a two-class model with independent labelers to counts of vote patterns.

    Votes are 1, -1 or 0 (no opinion). Returns the share of the positive class,
    per labeler the probability of a right vote on each class (given an
    opinion), and each pattern's posterior. ``start`` holds the first guesses of
    share and probabilities. Labelers are taken to be no worse than chance,
    which fixes which class is which.
    """
    labelers = len(next(iter(counts)))
    total = sum(counts.values())
    prior, rate = start[0], [start[1:]] * labelers
    post: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for pattern in counts:
            yes, no = prior, 1 - prior
            for v, (a, b) in zip(pattern, rate, strict=True):
                if v:
                    yes *= a if v > 0 else 1 - a
                    no *= 1 - b if v > 0 else b
            post[pattern] = yes / (yes + no)
        prior = min(0.99, max(0.01, sum(n * post[p] for p, n in counts.items()) / total))
        rate = []
        for j in range(labelers):
            right, seen, right_no, seen_no = 1.0, 2.0, 1.0, 2.0  # one right and one wrong vote beforehand
            for p, n in counts.items():
                if p[j]:
                    right += n * post[p] * (p[j] > 0)
                    seen += n * post[p]
                    right_no += n * (1 - post[p]) * (p[j] < 0)
                    seen_no += n * (1 - post[p])
            a, b = right / seen, right_no / seen_no
            rate.append((a, b) if a + b >= 1 else (0.5, 0.5))
    return prior, rate, post
