"""Plain sequential folds over one stream's events: what the stages must equal."""


def dedup(rows, ttl):
    """Indexes kept of ``(timestamp, payload)`` in order."""
    kept_at, kept = {}, []
    for i, (now, payload) in enumerate(rows):
        if payload in kept_at and now - kept_at[payload] <= ttl:
            continue
        kept_at[payload] = now
        kept.append(i)
    return kept


def threshold(values, delta):
    """Indexes kept of numbers in order; ``None`` is no number."""
    last, kept = None, []
    for i, value in enumerate(values):
        if value is None:
            kept.append(i)
        elif last is None or abs(value - last) >= delta:
            last = value
            kept.append(i)
    return kept


def batches(times, size, interval):
    """Batches as ``(flush time, indexes)``."""
    done, pending, due = [], [], None
    for i, now in enumerate(times):
        if due is None:
            due = now + interval
        while now >= due:
            if pending:
                done.append((due, pending))
                pending = []
            due += interval
        pending.append(i)
        if len(pending) == size:
            done.append((now, pending))
            pending, due = [], now + interval
    if pending:
        done.append((times[-1], pending))
    return done
