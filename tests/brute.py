"""Plain Python counterparts for small inputs."""

from itertools import combinations


def itemset_counts(carts, max_size=None):
    counts = {}
    for cart in carts.values():
        items = sorted(set(cart))
        for size in range(1, (max_size or len(items)) + 1):
            for subset in combinations(items, size):
                counts[subset] = counts.get(subset, 0) + 1
    return counts


def rules(carts, min_support, min_confidence, max_size=None):
    n = len(carts)
    support = {s: c / n for s, c in itemset_counts(carts, max_size).items() if c / n >= min_support}
    found = {}
    for whole, share in support.items():
        for size in range(1, len(whole)):
            for left in combinations(whole, size):
                right = tuple(i for i in whole if i not in left)
                confidence = share / support[left]
                if confidence >= min_confidence:
                    found[left, right] = (support[left], support[right], share, confidence, confidence / support[right])
    return found


def candidates(carts, pairs):
    """(order, trigger, position, recommended, label) per line and rule; a product bought again counts by its last position."""
    rows = []
    for order, cart in carts.items():
        for position, trigger in enumerate(cart, 1):
            for left, right in pairs:
                if left == trigger:
                    last = max((at for at, name in enumerate(cart, 1) if name == right), default=0)
                    rows.append((order, trigger, position, right, int(last > position)))
    return rows


def auc(pairs):
    """Share of (positive, negative) pairs in the right order, ties counting half."""
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    return wins / (len(pos) * len(neg))
