"""Row-by-row Python definitions of the analyses, for small inputs only."""

from __future__ import annotations

import math
from collections import defaultdict
from datetime import timedelta
from fractions import Fraction


def money(value):
    return Fraction(str(value))


def spread(amounts):
    """Exact population variance, or None."""
    if not amounts:
        return None
    values = [money(value) for value in amounts]
    mean = sum(values) / len(values)
    return sum((value - mean) ** 2 for value in values) / len(values)


def winners(rows, threshold):
    bought = [row for row in rows if "shipped" in row["status"].lower() and row["qty"] != 0 and row["state"] and row["size"]]
    totals = defaultdict(int)
    for row in bought:
        totals[row["state"]] += 1
    buckets = defaultdict(list)
    for row in bought:
        length = 5 if totals[row["state"]] > threshold else 10
        for later in range(1, length + 1):
            buckets[row["state"], row["order_date"] + timedelta(days=later), length, row["size"]].append(row["amount"])
    best = {}
    for (state, day, length, size), amounts in buckets.items():
        variance = spread([amount for amount in amounts if amount is not None])
        rank = (-len(amounts), variance is None, variance or 0, size)
        candidate = (rank, size, len(amounts), variance, length)
        if (state, day) not in best or rank < best[state, day][0]:
            best[state, day] = candidate
    return {key: value[1:] for key, value in best.items()}


def items(text):
    return [item.strip(" ") for item in (text or "").split(",") if item.strip(" ")]


def city_percentages(rows, min_days=2, min_promotions=3):
    seen = defaultdict(list)
    for row in rows:
        if row["order_date"]:
            for item in items(row["promotion_ids"]):
                seen[item].append(row["order_date"])
    valid = {item for item, days in seen.items() if (max(days) - min(days)).days >= min_days}
    amounts = defaultdict(list)
    for row in rows:
        if row["fulfilment"].lower() == "merchant" and row["courier_status"].lower() == "shipped" and row["state"]:
            if row["amount"] is not None:
                amounts[row["state"]].append(money(row["amount"]))
    found = defaultdict(lambda: [0, 0])
    for row in rows:
        if row["status"].lower() == "cancelled" and row["service_level"].lower() == "standard" and row["city"]:
            counts = found[row["city"]]
            counts[0] += 1
            known = amounts.get(row["state"])
            if known and row["amount"] is not None and money(row["amount"]) < sum(known) / len(known):
                counts[1] += len(set(items(row["promotion_ids"])) & valid) >= min_promotions
    return {city: (n, q, q * 100.0 / n) for city, (n, q) in found.items()}


def deviations(rows, levels):
    groups = defaultdict(list)
    for row in rows:
        if row["order_date"] and row["sku"]:
            groups[row["order_date"].strftime("%Y-%m"), row["sku"]].append((len(items(row["promotion_ids"])), row["amount"]))
    found = {}
    for (month, sku), members in groups.items():
        counts = sorted(count for count, _ in members)
        for label, p in levels.items():
            h = (len(counts) - 1.0) * p
            lower, upper = counts[math.floor(h)], counts[math.ceil(h)]
            thresholds = {
                "exact": lower + (h - math.floor(h)) * (upper - lower),
                "approx": float(counts[max(math.ceil(len(counts) * p), 1) - 1]),
            }
            for method, threshold in thresholds.items():
                kept = [amount for count, amount in members if count >= threshold]
                variance = spread([amount for amount in kept if amount is not None])
                deviation = 0.0 if len(kept) < 2 or variance is None else math.sqrt(variance)
                found[month, sku, method, label] = (threshold, len(kept), deviation)
    return found
