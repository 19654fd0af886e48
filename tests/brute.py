"""The two folds in plain Python over (key, seq, offset, op, value) tuples."""

from collections import defaultdict


def current(events):
    cut = max((e[1] for e in events if e[3] == "t"), default=None)
    newest = {}
    for key, seq, offset, op, value in events:
        if op != "t" and (key not in newest or (seq, offset) > newest[key][:2]):
            newest[key] = (seq, offset, op, value)
    return {
        (key, value)
        for key, (seq, offset, op, value) in newest.items()
        if op != "d" and (cut is None or seq > cut)
    }


def history(events):
    versions = defaultdict(dict)
    for key, seq, offset, op, value in events:
        if op != "t" and (seq not in versions[key] or offset > versions[key][seq][0]):
            versions[key][seq] = (offset, op, value)
    rows = set()
    for key, by_seq in versions.items():
        starts = sorted(by_seq)
        for start, end in zip(starts, [*starts[1:], None]):
            _, op, value = by_seq[start]
            if op != "d":
                rows.add((key, value, start, end))
    return rows
