"""Schemas of the source records and of the five tables. They are fixed: nothing is inferred, unknown keys are dropped
and missing ones are null.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, STRINGS, DATE, BOOL, LONG = T.StringType(), T.ArrayType(T.StringType()), T.DateType(), T.BooleanType(), T.LongType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


INGREDIENTS = T.ArrayType(struct(name=STRING, strength=STRING))

# Source records. Dates are texts; `openfda` is kept as JSON text and parsed where a field of it is read.
PACKAGING = struct(package_ndc=STRING, description=STRING, marketing_start_date=STRING, sample=BOOL)
PRODUCT_RECORD = struct(
    product_ndc=STRING, generic_name=STRING, labeler_name=STRING, brand_name=STRING, active_ingredients=INGREDIENTS,
    finished=BOOL, listing_expiration_date=STRING, openfda=STRING, marketing_category=STRING, dosage_form=STRING,
    spl_id=STRING, product_type=STRING, route=STRINGS, marketing_start_date=STRING, marketing_end_date=STRING,
    product_id=STRING, application_number=STRING, brand_name_base=STRING, pharm_class=STRINGS, dea_schedule=STRING,
    packaging=T.ArrayType(PACKAGING),
)
OPENFDA = struct(rxcui=STRINGS, product_type=STRINGS, product_ndc=STRINGS, package_ndc=STRINGS)

PRODUCT = struct(
    product_ndc=STRING, generic_name=STRING, labeler_name=STRING, brand_name=STRING, active_ingredients=INGREDIENTS,
    finished=BOOL, listing_expiration_date=DATE, openfda=STRING, marketing_category=STRING, is_otc=BOOL,
    dosage_form=STRING, short_dosage_form=STRING, spl_id=STRING, product_type=STRING, route=STRINGS,
    marketing_start_date=DATE, marketing_end_date=DATE, product_id=STRING, application_number=STRING,
    brand_name_base=STRING, pharm_class=STRINGS, dea_schedule=STRING, rxnorm_ids=STRINGS,
)
PACKAGE = struct(
    package_ndc=STRING, ndc11=STRING, product_ndc=STRING, description=STRING, size=LONG, size_extra=STRING,
    packages_number=LONG, package_format=STRING, marketing_start_date=DATE, sample=BOOL,
)

#: Sections of a label; each has a twin whose name ends in _table.
LABEL_SECTIONS = """
abuse controlled_substance dependence drug_abuse_and_dependence overdosage adverse_reactions
drug_and_or_laboratory_test_interactions drug_interactions clinical_pharmacology mechanism_of_action pharmacodynamics
pharmacokinetics active_ingredient contraindications description dosage_and_administration dosage_forms_and_strengths
inactive_ingredient indications_and_usage purpose spl_product_data_elements animal_pharmacology_and_or_toxicology
carcinogenesis_and_mutagenesis_and_impairment_of_fertility nonclinical_toxicology laboratory_tests microbiology
package_label_principal_display_panel recent_major_changes spl_unclassified_section ask_doctor
ask_doctor_or_pharmacist do_not_use information_for_owners_or_caregivers information_for_patients instructions_for_use
keep_out_of_reach_of_children other_safety_information patient_medication_information questions spl_medguide
spl_patient_package_insert stop_use when_using clinical_studies references geriatric_use labor_and_delivery
nursing_mothers pediatric_use pregnancy pregnancy_or_breast_feeding teratogenic_effects use_in_specific_populations
how_supplied safe_handling_warning storage_and_handling boxed_warning general_precautions precautions
user_safety_warnings warnings
""".split()
LABEL_TEXTS = [name for section in LABEL_SECTIONS for name in (section, f"{section}_table")]
LABEL_KEYS = ["effective_time", "id", "set_id", "version"]
LABEL_RECORD = T.StructType([T.StructField(c, STRINGS) for c in LABEL_TEXTS] + [T.StructField(c, STRING) for c in [*LABEL_KEYS, "openfda"]])
LABEL = T.StructType([T.StructField(c, STRING) for c in [*LABEL_TEXTS, *LABEL_KEYS, "openfda"]] + [T.StructField("product_ndc", STRINGS), T.StructField("package_ndc", STRINGS)])

EVIDENCE = struct(
    evidence_id=STRING, set_id=STRING, label_id=STRING, product_ndc=STRINGS, package_ndc=STRINGS, rxnorm_ids=STRINGS,
    condition_system=STRING, condition_code=STRING, evidence_text=STRING, evidence_source=STRING,
    confidence=T.DoubleType(), source_attribution=STRING, imported_at=T.TimestampNTZType(),
)
RELATIONSHIP = struct(from_system=STRING, from_code=STRING, to_system=STRING, to_code=STRING, relationship=STRING, source_attribution=STRING)
CATALOG = struct(code_system=STRING, code=STRING, code_type=STRING, display_name=STRING, source_attribution=STRING)
SYNONYM = struct(code_system=STRING, code=STRING, synonym=STRING, term_type=STRING)

PARTITIONS = T.ArrayType(struct(file=STRING, records=STRING))
MANIFEST = struct(results=struct(drug=struct(ndc=struct(total_records=STRING, partitions=PARTITIONS), label=struct(total_records=STRING, partitions=PARTITIONS))))

PROGRESS = struct(unit=STRING, done=T.DoubleType(), total=T.DoubleType(), pct=T.DoubleType(), message=STRING, phase=STRING, updated_at=STRING)
