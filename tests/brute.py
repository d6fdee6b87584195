"""Sequential reference models of the rules (plain Python, small inputs only)."""

from collections import defaultdict


def movie_summary(rows):
    """rows: (movie, date, user, rating) → {movie: dict} by the reference's loop rule."""
    by = defaultdict(list)
    for m, d, u, r in rows:
        by[m].append((d, u, r))
    out = {}
    for m, ev in by.items():
        ev.sort()
        n = len(ev)
        s = sum(r for _, _, r in ev)
        s2 = sum(r * r for _, _, r in ev)
        mean = s / n
        first = min(d for d, _, _ in ev)
        row = {"ratings": n, "rating_mean": mean, "rating_var": s2 / n - mean * mean,
               "first_rating": first, "last_rating": max(d for d, _, _ in ev)}
        for i in range(1, 11):
            idx = (n * i) // 10 - 1 if n * i > 10 else 0
            row[f"viewdate{i - 1}"] = ev[idx][0] - first
        for i in range(10):
            rate = sum(ev[k][2] for k in range((n * i) // 10, (n * (i + 1)) // 10))
            row[f"ratingdate{i}"] = rate / n * 10
        out[m] = row
    return out
