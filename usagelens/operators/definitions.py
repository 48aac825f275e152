"""Agent definition documents -> directory rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens import constants as C
from usagelens.functions.columns import is_system_agent, last_segment, non_empty


def list_agents(engines: DataFrame, assistants: DataFrame, agents: DataFrame) -> DataFrame:
    """Agents found below the assistants of the listed engines, with their engine id."""

    def parent(path: Column) -> Column:
        return F.regexp_extract(path, "^(.*)/[^/]+/[^/]+$", 1)

    hosts = assistants.filter(non_empty(F.col("name")).isNotNull()).select(
        F.col("name").alias("assistant_name"), parent(F.col("name")).alias("engine_name")
    )
    listed = engines.filter(non_empty(F.col("name")).isNotNull()).select(
        F.col("name").alias("engine_name")
    )
    return (
        agents.withColumn("assistant_name", parent(F.col("name")))
        .join(hosts.join(listed, "engine_name"), "assistant_name")
        .drop("assistant_name")
        .withColumn("engine_id", last_segment(F.col("engine_name")))
    )


def attach_datastores(engines: DataFrame, stores: DataFrame) -> DataFrame:
    """Comma-joined store ids and names per engine, in the engine's own order.

    Store names are looked up by a join, so the store list may be of any size.
    """
    listed = engines.select(
        F.col("name").alias("engine_name"), F.posexplode_outer("dataStoreIds").alias("pos", "store_id")
    )
    names = stores.select(F.col("id").alias("store_id"), F.col("displayName").alias("store_name"))
    named = listed.join(names, "store_id", "left")
    entry = F.struct("pos", "store_id", F.coalesce("store_name", "store_id").alias("store_name"))
    grouped = named.groupBy("engine_name").agg(
        F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), entry))).alias("listed")
    )
    return grouped.select(
        "engine_name",
        F.array_join(F.col("listed.store_id"), ",").alias("datastore_ids"),
        F.array_join(F.col("listed.store_name"), ",").alias("datastore_names"),
    )


def _instruction(node: Column) -> Column:
    return node["llmAgentNode"]["instruction"]


def _has_instruction(node: Column) -> Column:
    return F.coalesce(_instruction(node), F.lit("")) != ""


def flatten_definitions(listed: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Full directory rows from agent documents.

    ``listed`` holds name, displayName, draftDisplayName and whatever of engine_name,
    datastore_ids and datastore_names is known; ``details`` (by name) holds the definitions. Without
    ``details`` the listed documents are the definitions. An agent without details keeps its listed
    metadata.
    """
    if details is None:
        listed = listed.withColumn("found", F.lit(True))
        listed_name = F.coalesce("displayName", "draftDisplayName")
    else:
        found = details.withColumn("found", F.lit(True)).withColumnRenamed("name", "detail_name")
        kept = [c for c in listed.columns if c not in ("displayName", "draftDisplayName")]
        listed = listed.select(
            *kept, F.coalesce("displayName", "draftDisplayName").alias("listed_name")
        ).join(found, F.col("name") == F.col("detail_name"), "left")
        listed_name = F.col("listed_name")

    low = F.col("lowCodeAgentDefinition")
    # the first key that is present wins, even with an empty list
    nodes = F.coalesce(low["deployedNodes"], low["draftAgents"], low["nodes"], low["agents"])
    root_id = F.coalesce(
        low["deployedRootAgentId"],
        low["rootAgentId"],
        low["draftRootAgentId"],
        F.lit(C.DEFAULT_ROOT_NODE),
    )

    def is_root(node: Column) -> Column:
        return node["id"].eqNullSafe(F.col("root_id"))

    def label(node: Column) -> Column:
        return F.coalesce(node["displayName"], F.lit(C.DEFAULT_NODE_NAME))

    staged = listed.filter(non_empty(F.col("name")).isNotNull()).withColumns(
        {
            "agent_type": F.when(F.col("adkAgentDefinition").isNotNull(), C.TYPE_CODE)
            .when(low.isNotNull(), C.TYPE_BUILDER)
            .when(F.col("managedAgentDefinition").isNotNull(), C.TYPE_MANAGED)
            .otherwise(C.TYPE_UNKNOWN),
            "root_id": root_id,
        }
    )
    is_builder = F.col("agent_type") == C.TYPE_BUILDER
    staged = staged.withColumn("node_list", F.when(is_builder, nodes))
    node_list = F.col("node_list")
    # a later root node goes in front of an earlier one
    root_text = F.aggregate(
        F.filter(node_list, lambda n: is_root(n) & _has_instruction(n)),
        F.lit(""),
        lambda so_far, n: F.concat(_instruction(n), F.lit("\n\n"), so_far),
    )
    sub_lines = F.transform(
        F.filter(node_list, lambda n: ~is_root(n) & _has_instruction(n)),
        lambda n: F.concat(F.lit("["), label(n), F.lit("] "), _instruction(n)),
    )
    sub_text = F.when(
        F.size(sub_lines) > 0, F.concat(F.lit(C.SUB_AGENT_HEADING), F.array_join(sub_lines, "\n"))
    ).otherwise("")
    node_text = F.concat(root_text, sub_text)
    prompts = F.filter(
        F.transform(F.col("instructions.systemInstructions"), lambda i: i["instruction"]),
        lambda text: F.coalesce(text, F.lit("")) != "",
    )
    sub_names = F.transform(F.filter(node_list, lambda n: ~is_root(n)), label)

    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in listed.columns else F.lit("")

    engine = known("engine_name")
    return staged.select(
        last_segment(F.col("name")).alias("agent_id"),
        F.coalesce(
            "displayName", "draftDisplayName", listed_name, F.lit(C.UNKNOWN_DISPLAY_NAME)
        ).alias("display_name"),
        F.when(engine == "", F.lit(C.DEFAULT_ENGINE)).otherwise(last_segment(engine)).alias("engine_id"),
        F.coalesce("description", "draftDescription", F.lit("")).alias("description"),
        F.coalesce(non_empty(node_text), F.array_join(prompts, "\n"), F.lit("")).alias(
            "system_instructions"
        ),
        known("datastore_ids").alias("datastore_ids"),
        known("datastore_names").alias("datastore_names"),
        "agent_type",
        F.coalesce(F.array_join(sub_names, ", "), F.lit("")).alias("sub_agents"),
    )


def flatten_definitions_light(agents: DataFrame) -> DataFrame:
    """Five-column update rows: no system agents, instruction of the first node only."""
    low = F.col("lowCodeAgentDefinition")
    nodes = F.when(F.size(low["nodes"]) > 0, low["nodes"]).otherwise(low["deployedNodes"])
    agent_id = last_segment(F.coalesce("name", F.lit("")))
    return (
        agents.withColumn("agent_id", agent_id)
        .filter((F.col("agent_id") != "") & ~is_system_agent(F.col("agent_id")))
        .select(
            "agent_id",
            F.coalesce("displayName", F.lit("")).alias("display_name"),
            F.when(F.col("adkAgentDefinition").isNotNull(), C.TYPE_CODE)
            .when(F.col("managedAgentDefinition").isNotNull(), C.TYPE_MANAGED)
            .otherwise(C.TYPE_DESIGNER)
            .alias("agent_type"),
            F.coalesce("description", F.lit("")).alias("description"),
            F.coalesce(_instruction(F.get(nodes, 0)), F.lit("")).alias("system_instructions"),
        )
    )
