"""Sequential forms of the rules, for small inputs only."""


def near_marks(sets, threshold, rule="overlap"):
    """sets: list of (id, set) in order -> {id: (matched_id, similarity)} of the near duplicates."""
    kept, marks = [], {}
    for page, own in sets:
        best = None
        for other, stored in kept:
            common = len(own & stored)
            if not common:
                continue
            similarity = common / (len(own) + len(stored) - common)
            first = common if rule == "overlap" else similarity
            rank = (-first, len(stored), other)
            if best is None or rank < best[0]:
                best = (rank, other, similarity)
        if best and best[2] > threshold:
            marks[page] = (best[1], best[2])
        elif own:
            kept.append((page, own))
    return marks


def admitted(sizes, limit):
    stored, out = 0, []
    for size in sizes:
        fits = stored + size < limit
        stored += size if fits else 0
        out.append(fits)
    return out
