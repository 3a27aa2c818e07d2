"""Register snapshots: nested JSON kept as text in bronze, parsed into typed areas with quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrain.functions.parse import instant_of, missing
from tidegrain.schemas import AREA, QUARANTINE, conform

LINEAGE = ["source_id", "raw_file", "record_index", "ingested_at"]
# The register's field names.
VERSION, DEACTIVATED, CHANGED, ENDED, NAME = "aktivVersjon", "deaktivert", "sistEndret", "deaktivertTidspunkt", "navn"
COUNTS = {"paid_spaces": "antallAvgiftsbelagtePlasser", "free_spaces": "antallAvgiftsfriePlasser", "charging_spaces": "antallLadeplasser", "disabled_spaces": "antallForflytningshemmede"}


def parse_areas(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Areas (register_id, counts, times) and their quarantine. A row without a digits-only id is no area.

    The JSON type of a count decides: an integer of 0 or more counts; a fraction, text, true or a negative is quarantined
    as the source wrote it. Times must carry a zone. A JSON null for the version counts as absent.
    """
    col = lambda n: F.col(n) if n in bronze.columns else F.lit(None).cast("string")
    id_, version, ended = col("id"), col(VERSION), col(DEACTIVATED)
    b = bronze.select(*LINEAGE, id_.alias("_id"), version.alias("_version"), ended.alias("_ended"))
    b = b.withColumns({"_v": F.try_parse_json("_version"), "_e": F.try_parse_json("_ended")})
    b = b.withColumns({"_kind": F.schema_of_variant("_v"), "_id_ok": F.col("_id").rlike(r"^[0-9]+\z"), "_key": F.when(F.col("_id").rlike(r"^[0-9]+\z"), F.col("_id").try_cast("bigint"))})
    get = lambda n: F.get_json_object("_version", f"$.{n}")
    sound = F.col("_kind").startswith("OBJECT")
    made, rules = {}, []
    q = lambda name, raw, reason: F.struct(F.lit(name).alias("field"), raw.alias("raw_value"), reason.alias("reason"))
    rules.append(q("id", F.col("_id"), F.when(missing(F.col("_id")), "missing_value").when(F.col("_key").isNull(), "invalid_value")))
    none = F.col("_version").isNull() | (F.col("_version") == "")
    rules.append(q(VERSION, F.col("_version"), F.when(none, "missing_value").when(~F.coalesce(sound, F.lit(False)) & ~(F.trim("_version") == "null"), "invalid_json")))
    for name, source in COUNTS.items():
        part = F.try_variant_get("_v", f"$.{source}", "variant")
        kind, value = F.schema_of_variant(part), F.try_variant_get("_v", f"$.{source}", "int")
        ok = (kind == "BIGINT") & (value >= 0)
        made[name] = F.when(sound & ok, value)
        rules.append(q(f"{VERSION}.{source}", get(source), F.when(sound & part.isNotNull() & (kind != "VOID") & ~F.coalesce(ok, F.lit(False)), "not_a_count")))
    changed, over = get(CHANGED), F.get_json_object("_ended", f"$.{ENDED}")
    made |= {"register_id": F.col("_key"), "name": F.when(sound, get(NAME)), "changed_at": F.when(sound, instant_of(changed)), "deactivated_at": instant_of(over)}
    rules.append(q(f"{VERSION}.{CHANGED}", changed, F.when(sound & missing(changed), "missing_value").when(sound & instant_of(changed).isNull(), "invalid_value")))
    rules.append(q(f"{DEACTIVATED}.{ENDED}", over, F.when(over.isNotNull() & instant_of(over).isNull(), "invalid_value")))
    areas = b.withColumns(made).where(F.col("register_id").isNotNull())
    bad = b.select(*LINEAGE, F.explode(F.filter(F.array(*rules), lambda x: x["reason"].isNotNull())).alias("q")).select(*LINEAGE, "q.*", F.lit(False).alias("reading_excluded"))
    return conform(areas, AREA), conform(bad, QUARANTINE)
