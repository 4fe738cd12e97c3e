"""Locating components through the port connections of the system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.functions import join_peers, second_port


def directed_edges(connections: DataFrame) -> DataFrame:
    """Both directions of every usable connection, in one pass, copies kept.

    Incomplete rows and self-connections are dropped: a comparison with null drops a
    missing component.
    """
    usable = connections.withColumn("port2", second_port(F.col("port1"), F.col("port2"))).filter(
        "port1 is not null and port2 is not null and component1 <> component2"
    )
    ends = F.array(
        F.struct(
            F.col("component1").alias("component"), F.col("port1").alias("port"), F.col("component2").alias("peer")
        ),
        F.struct(
            F.col("component2").alias("component"), F.col("port2").alias("port"), F.col("component1").alias("peer")
        ),
    )
    return usable.select(F.explode(ends).alias("end")).select("end.*")


def port_edges(connections: DataFrame) -> DataFrame:
    """The set of (component, port, peer)."""
    return directed_edges(connections).distinct()


def port_peers(connections: DataFrame, ports: DataFrame | None = None) -> DataFrame:
    """One row per connected (component, port): its peer, and whether there are several; of ``ports`` (port) only.

    Smallest and largest peer decide that, so a hub with any number of connections
    collapses before the shuffle; its peers are never gathered.
    """
    edges = directed_edges(connections)
    if ports is not None:
        edges = edges.join(ports, "port", "left_semi")
    return edges.groupBy("component", "port").agg(
        F.min("peer").alias("peer"), (F.min("peer") != F.max("peer")).alias("ambiguous")
    )


def _problem(component: Column, port: Column, peer: Column, ambiguous: Column) -> Column:
    rule = F.when(peer.isNull(), "no_peer").when(ambiguous, "several_peers")
    return F.concat(rule, F.lit(": "), component, F.lit("."), port)


def peer_violations(needed: DataFrame, connections: DataFrame) -> DataFrame:
    """Needed (component, port) pairs that do not have exactly one peer."""
    pairs = needed.select("component", "port").distinct()
    found = pairs.join(port_peers(connections), ["component", "port"], "left")
    problem = _problem(F.col("component"), F.col("port"), F.col("peer"), F.col("ambiguous"))
    return found.select("component", "port", problem.alias("problem")).filter(F.col("problem").isNotNull())


def port_maps(connections: DataFrame, ports: DataFrame) -> DataFrame:
    """One row per connected component: ``peers``, a map from its ports to (peer, ambiguous).

    Only the ports in ``ports`` (port) enter a map, so its size is bounded by the ports that terms name, however
    many a hub has.
    """
    asked = port_peers(connections, ports)
    entry = F.struct("port", F.struct("peer", "ambiguous"))
    return asked.groupBy("component").agg(F.map_from_entries(F.collect_set(entry)).alias("peers"))


def location_port_names(rows: DataFrame) -> DataFrame:
    """The ports (port) that ``location_ports`` of some rows name."""
    return rows.select(F.explode("location_ports").alias("port"))


def locate(rows: DataFrame, keys: list[str], connections: DataFrame, ports: DataFrame | None = None) -> DataFrame:
    """``keys`` of every row, ``location_ports``, ``location_problem`` and ``metric_location``.

    ``rows`` has ``component`` and ``location_ports`` (null: the component itself; else
    the peers behind the ports, joined in port order). A row that cannot be located has
    a null location and says why. Rows are joined once, with the map of their component's peers;
    their ports are never taken apart into rows. ``ports`` (port) are those that rows can name, where a smaller table than
    ``rows`` tells them.
    """
    named = F.col("location_ports")
    needed = location_port_names(rows).distinct() if ports is None else ports
    found = rows.join(port_maps(connections, needed), "component", "left").withColumn(
        "_asked",
        F.transform(
            F.filter(named, lambda port: port.isNotNull()),
            lambda port: F.struct(port.alias("port"), F.try_element_at("peers", port).alias("found")),
        ),
    )
    problems = F.transform(
        "_asked", lambda a: _problem(F.col("component"), a["port"], a["found"]["peer"], a["found"]["ambiguous"])
    )
    found = found.withColumn("location_problem", F.get(F.filter(problems, lambda p: p.isNotNull()), F.lit(0)))
    peers = join_peers(F.transform("_asked", lambda a: a["found"]["peer"]))
    return found.select(
        *keys,
        "location_ports",
        "location_problem",
        F.when(named.isNull(), F.col("component"))
        .when(F.col("location_problem").isNull(), peers)
        .alias("metric_location"),
    )
