"""The view by loops over Python rows: slow, plain, and independent of Spark."""

from __future__ import annotations

from collections import defaultdict


def brute_filter(simulation, calendar):
    """simulation rows as dicts, calendar as (index, block, date)."""
    dates = {(i, b): d for i, b, d in calendar}
    kept = []
    for row in simulation:
        if row["absolute_time_index"] is None:
            kept.append({**row, "granular_date": None})
        elif (row["absolute_time_index"], row["block"]) in dates:
            kept.append({**row, "granular_date": dates[row["absolute_time_index"], row["block"]]})
    return kept


def brute_peers(connections):
    peers = defaultdict(set)
    for c1, p1, c2, p2 in connections:
        p2 = p1 if p2 is None else p2
        if None in (c1, p1, c2) or c1 == c2:
            continue
        peers[c1, p1].add(c2)
        peers[c2, p2].add(c1)
    return peers


def brute_structure(terms, models, components, connections):
    """Bag of (component, location, output) of one metric's terms."""
    peers = brute_peers(connections)
    rows = []
    for category, output, ports in terms:
        for model, model_category in models:
            if model_category != category:
                continue
            for component, reference in components:
                if reference != f"lib.{model}":
                    continue
                if ports is None:
                    location = component
                else:
                    found = []
                    for port in ports:
                        (peer,) = peers[component, port]
                        found.append(peer)
                    location = "|".join(found)
                rows.append((component, location, output))
    return rows


def brute_view(simulation, calendar, metrics, models, components, connections, references):
    """Sorted view rows. ``metrics`` maps (catalog, metric) to (operator, terms)."""
    facts = defaultdict(list)
    for row in brute_filter(simulation, calendar):
        facts[row["component"], row["output"]].append(row)
    nothing = {"absolute_time_index": None, "scenario_index": None, "granular_date": None, "value": None}
    view = []
    for catalog, metric in references:
        if (catalog, metric) not in metrics:
            continue
        operator, terms = metrics[catalog, metric]
        groups = defaultdict(list)
        for component, location, output in brute_structure(terms, models, components, connections):
            for row in facts.get((component, output)) or [nothing]:
                key = (location, row["absolute_time_index"], row["scenario_index"], row["granular_date"])
                groups[key].append(row["value"])
        dated = defaultdict(float)
        for (location, _, scenario, date), values in groups.items():
            given = [v for v in values if v is not None]
            if operator == "avg":
                value = sum(given) / len(given) if given else None
            else:
                value = sum(given)
            dated[location, scenario, date] += value or 0.0
        view += [(metric, loc, "", date, scenario, round(v, 6)) for (loc, scenario, date), v in dated.items()]
    return sorted(view, key=str)
