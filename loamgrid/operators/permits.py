"""Records of public sources in their common forms: permits of map features, and registry lines as a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamgrid.functions import identity, text
from loamgrid.functions.coerce import epoch_ms_date, portal_money, to_text
from loamgrid.operators.records import label_map


def permits_of_features(
    features: DataFrame, statuses: dict[int, str], types: dict[int, str], county: str, jurisdiction: str, source: str, city: str, state: str
) -> DataFrame:
    """One permit row per map feature: the 20 columns of the permit table, then work_address, contractor and related.

    Codes that ``statuses`` lacks read ``Status n``; a type that ``types`` lacks is the permit number's first part. The
    date a fee was paid issues a permit, else the date it was entered; a finalised one closes, an expired one expires,
    on the day of its last update. A feature without RecordID and OBJECTID is an error.
    """
    words = lambda c: to_text(F.col(c).cast("string"))
    day = lambda c: F.date_format(epoch_ms_date(F.col(c).cast("string")), "yyyy-MM-dd")
    none = F.raise_error(F.lit("a feature has neither RecordID nor OBJECTID")).cast("string")
    record = F.coalesce(words("RecordID"), words("OBJECTID"), none)
    decoded = lambda c, labels: F.try_element_at(label_map({str(k): v for k, v in labels.items()}), words(c))
    status = F.coalesce(decoded("Status", statuses), F.concat(F.lit("Status "), words("Status")))
    kind = F.coalesce(decoded("PermitTypeID", types), F.substring_index(words("FullPermitNumber"), "-", 1))
    opened, updated, looked = day("DateEntered"), day("DateUpdated"), day("DateLastInspection")
    final, expired = F.coalesce(status.rlike(r"(?i)^finalized\b"), F.lit(False)), F.coalesce(status == "Expired", F.lit(False))
    place = F.concat_ws(", ", words("ADDR"), F.concat(F.lit("#"), words("APTNUM")), F.coalesce(words("CITY"), F.lit(city)), F.lit(state), words("ZIPCODE"))
    absent = F.lit(None).cast("string")
    return features.select(
        identity.permit_id(F.lit(county.lower()), F.lit(jurisdiction), record).alias("property_improvement_id"),
        absent.alias("property_id"),
        text.parcel_dashed(words("RE")).alias("parcel_identifier"),
        words("FullPermitNumber").alias("permit_number"),
        kind.alias("improvement_type"),
        status.alias("improvement_status"),
        words("TypeOfWork").alias("improvement_action"),
        F.coalesce(day("PaidDay"), opened).alias("permit_issue_date"),
        opened.alias("application_received_date"),
        looked.alias("final_inspection_date"),
        F.when(final, updated).alias("permit_close_date"),
        F.when(final, F.coalesce(looked, updated)).alias("completion_date"),
        F.when(expired, updated).alias("expiration_date"),
        opened.alias("opened_date"),
        F.lit(source).alias("source_system"),
        F.lit(county).alias("county_name"),
        words("ProposedUseDesc").alias("project_description"),
        words("Comments").alias("description"),
        portal_money(words("TotalCost")).alias("estimated_job_value"),
        F.lit(None).cast("double").alias("fee"),
        place.alias("work_address"),
        words("CompanyName").alias("contractor"),
        words("AssociatePermitID").alias("related"),
    )


def _address(*parts: Column) -> Column:
    """struct(id, text) of an address from its parts, null without any; equal addresses share an id."""
    line = F.nullif(text.registry_address(F.concat_ws(" ", *parts)), F.lit(""))
    return F.when(line.isNotNull(), F.struct(F.concat(F.lit("address:"), F.substring(F.sha2(line, 256), 1, 32)).alias("id"), line.alias("text")))


def registry_graph(entities: DataFrame, source: str = "registry") -> tuple[DataFrame, DataFrame]:
    """(vertices (id, label, name), edges (label, src, dst)) of registry rows as ``parse_fixed_width`` gives them.

    Five classes: company, business_registration, its bridge business_registration_address (principal and mailing),
    business_registration_party (the agent and the officers) and address; five relationships between them. Vertices and
    edges that several rows give come once; parties without a name and addresses without text are left out.
    """
    key = F.concat(F.lit(f"{source}:"), "documentNumber")
    registration, company = F.concat(key, F.lit(":business_registration")), F.concat(key, F.lit(":company"))
    agent = ("registeredAgentAddress", "registeredAgentCity", "registeredAgentState", "registeredAgentZip")
    party = lambda role, name, kind, title, n, address: F.struct(
        F.concat(registration, F.lit(f":party:{role}:"), F.substring(F.sha2(F.concat_ws("\x00", name, kind, title, n), 256), 1, 16)).alias("id"),
        name.alias("name"),
        address.alias("address"),
    )
    no_text = F.lit(None).cast("string")
    agents = F.array(party("registered_agent", F.col("registeredAgentName"), F.col("registeredAgentType"), no_text, no_text, _address(*map(F.col, agent))))
    officers = F.transform(
        "officers",
        lambda o, i: party("officer", o["name"], o["type"], o["title"], (i + 1).cast("string"), _address(o["address"], o["city"], o["state"], o["zip"])),
    )
    rows = entities.select(
        registration.alias("r"),
        company.alias("c"),
        F.coalesce("entityName", "documentNumber").alias("name"),
        _address(*map(F.col, ("address1", "address2", "city", "state", "zip"))).alias("principal"),
        _address(*map(F.col, ("mailAddress1", "mailAddress2", "mailCity", "mailState", "mailZip"))).alias("mailing"),
        F.filter(F.concat(agents, officers), lambda p: p["name"].isNotNull()).alias("parties"),
    )
    vertex = lambda id_, label, name: F.struct(id_.alias("id"), F.lit(label).alias("label"), name.alias("name"))
    edge = lambda label, src, dst: F.struct(F.lit(label).alias("label"), src.alias("src"), dst.alias("dst"))
    bridges = {name: F.concat(F.col("r"), F.lit(f":address:{name}")) for name in ("principal", "mailing")}
    some = {name: F.col(name).isNotNull() for name in bridges}
    vs = [vertex(F.col("c"), "company", F.col("name")), vertex(F.col("r"), "business_registration", F.col("name"))]
    es = [edge("company_has_business_registration", F.col("c"), F.col("r"))]
    for name, bridge in bridges.items():
        vs.append(F.when(some[name], vertex(bridge, "business_registration_address", F.lit(name.upper()))))
        vs.append(F.when(some[name], vertex(F.col(f"{name}.id"), "address", F.col(f"{name}.text"))))
        es.append(F.when(some[name], edge("business_registration_has_address", F.col("r"), bridge)))
        es.append(F.when(some[name], edge("business_registration_address_has_address", bridge, F.col(f"{name}.id"))))
    located = F.filter("parties", lambda p: p["address"].isNotNull())
    vertices = F.concat(
        F.array_compact(F.array(*vs)),
        F.transform("parties", lambda p: vertex(p["id"], "business_registration_party", p["name"])),
        F.transform(located, lambda p: vertex(p["address"]["id"], "address", p["address"]["text"])),
    )
    edges = F.concat(
        F.array_compact(F.array(*es)),
        F.transform("parties", lambda p: edge("business_registration_has_party", F.col("r"), p["id"])),
        F.transform(located, lambda p: edge("business_registration_party_has_address", p["id"], p["address"]["id"])),
    )
    nodes = rows.select(F.inline(vertices)).groupBy("id", "label").agg(F.min("name").alias("name"))
    return nodes, rows.select(F.inline(edges)).distinct()
