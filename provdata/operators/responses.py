"""Enrichment / validation API responses as data (ENR1, ENR6, ENR7, ENR8).

The network calls themselves are outside Spark; their JSON responses are
parsed here with ``from_json`` against explicit schemas (JVM-side, no Python
per row) into typed columns, then joined back to the records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERSON_SCHEMA = (
    "error string, person struct<id: string, email: string, email_status: string, linkedin_url: string, "
    "city: string, state: string, country: string, "
    "phone_numbers: array<struct<type: string, sanitized_number: string>>, "
    "employment_history: array<struct<organization_name: string, title: string>>, "
    "organization: struct<name: string, primary_domain: string>>")

ADDRESS_SCHEMA = (
    "error string, status string, deliverable boolean, "
    "address struct<delivery_line_1: string, delivery_line_2: string, city: string, state: string, "
    "zip: string, zip4: string>, metadata struct<dpv_match: string, dpv_footnotes: array<string>, confidence: double>")

PHONE_SCHEMA = (
    "phone_number string, national_format string, country_code string, valid boolean, "
    "line_type_intelligence struct<type: string, carrier_name: string>, carrier struct<name: string, type: string>")


def _blank_to_null(c):
    return F.when(c != "", c)


def parse_person_response(df: DataFrame, json_col: str = "response") -> DataFrame:
    """ENR1: error -> api_error; no person -> 'No match found'; last mobile / last other phone;
    first employment is current; company falls back to the organisation name."""
    # Parse once into a column; every field below reads that column (an expression repeated inside
    # CASE branches would be re-evaluated per field).
    df = df.select("*", F.from_json(F.col(json_col), PERSON_SCHEMA).alias("_r"),
                   F.get_json_object(F.col(json_col), "$.person").alias("_person_txt"))
    base_cols = [c for c in df.columns if c not in ("_r", "_person_txt")]
    r = F.col("_r")
    person_txt = F.col("_person_txt")
    # The source tests key presence ("error" in response), so a null error still counts.
    has_error = F.coalesce(F.array_contains(F.json_object_keys(F.col(json_col)), "error"), F.lit(False))
    no_person = person_txt.isNull() | (F.regexp_replace(person_txt, r"\s", "") == "{}")
    p = r["person"]
    phones = p["phone_numbers"]
    mobiles = F.filter(phones, lambda x: x["type"] == "mobile")
    others = F.filter(phones, lambda x: F.coalesce(x["type"], F.lit("")) != "mobile")
    first_job = F.get(p["employment_history"], 0)
    ok = ~has_error & ~no_person
    v = lambda c: F.when(ok, c)
    company = F.coalesce(_blank_to_null(first_job["organization_name"]), p["organization"]["name"])
    return df.select(
        *base_cols,
        F.when(has_error, r["error"]).when(no_person, F.lit("No match found")).alias("api_error"),
        v(p["id"]).alias("apollo_id"), v(p["email"]).alias("email"), v(p["email_status"]).alias("email_status"),
        v(F.try_element_at(others, F.lit(-1))["sanitized_number"]).alias("phone"),
        v(F.try_element_at(mobiles, F.lit(-1))["sanitized_number"]).alias("mobile_phone"),
        v(p["linkedin_url"]).alias("linkedin_url"),
        v(company).alias("company_name"), v(first_job["title"]).alias("title"),
        v(p["organization"]["primary_domain"]).alias("company_domain"),
        v(p["city"]).alias("apollo_city"), v(p["state"]).alias("apollo_state"),
        v(p["country"]).alias("apollo_country"))


def parse_address_response(df: DataFrame, json_col: str = "response") -> DataFrame:
    """ENR6: valid = status 'valid' and deliverable; lines joined by a space skipping blanks;
    confidence defaults to 0; text fields default to ''. An error response is invalid with blanks."""
    df = df.select("*", F.from_json(F.col(json_col), ADDRESS_SCHEMA).alias("_r"))
    base_cols = [c for c in df.columns if c != "_r"]
    r = F.col("_r")
    err = r["error"].isNotNull()
    a, m = r["address"], r["metadata"]
    t = lambda c: F.when(err, F.lit("")).otherwise(F.coalesce(c, F.lit("")))
    l1, l2 = F.coalesce(a["delivery_line_1"], F.lit("")), F.coalesce(a["delivery_line_2"], F.lit(""))
    return df.select(
        *base_cols,
        (~err & (F.coalesce(r["status"], F.lit("unknown")) == "valid")
         & F.coalesce(r["deliverable"], F.lit(False))).alias("valid"),
        F.when(err, F.lit(0.0)).otherwise(F.coalesce(m["confidence"], F.lit(0.0))).alias("confidence"),
        F.when(err, F.lit("")).otherwise(F.concat_ws(" ", _blank_to_null(l1), _blank_to_null(l2)))
        .alias("normalized_address"),
        t(a["delivery_line_1"]).alias("delivery_line_1"), t(a["delivery_line_2"]).alias("delivery_line_2"),
        t(a["city"]).alias("city"), t(a["state"]).alias("state"), t(a["zip"]).alias("zip"),
        t(a["zip4"]).alias("zip4"), F.when(~err, m["dpv_match"]).alias("dpv_match"),
        F.when(err, F.array().cast("array<string>")).otherwise(
            F.coalesce(m["dpv_footnotes"], F.array().cast("array<string>"))).alias("dpv_footnotes"))


def parse_phone_response(df: DataFrame, json_col: str = "response") -> DataFrame:
    """ENR7: line type from line-type intelligence, else carrier type, else 'unknown'; carrier name
    likewise; confidence 1 when valid else 0."""
    df = df.select("*", F.from_json(F.col(json_col), PHONE_SCHEMA).alias("_r"))
    base_cols = [c for c in df.columns if c != "_r"]
    r = F.col("_r")
    lt, ca = r["line_type_intelligence"], r["carrier"]
    valid = F.coalesce(r["valid"], F.lit(False))
    return df.select(
        *base_cols, valid.alias("valid"), F.when(valid, 1.0).otherwise(0.0).alias("confidence"),
        F.coalesce(r["national_format"], F.lit("")).alias("formatted_number"),
        F.coalesce(r["phone_number"], F.lit("")).alias("e164_format"),
        F.coalesce(_blank_to_null(lt["type"]), ca["type"], F.lit("unknown")).alias("line_type"),
        F.coalesce(_blank_to_null(lt["carrier_name"]), _blank_to_null(ca["name"]), F.lit("unknown")).alias("carrier"),
        F.coalesce(r["country_code"], F.lit("")).alias("country_code"))


def validated_contacts(records: DataFrame, addr: DataFrame, phone: DataFrame, key: str = "provider_id") -> DataFrame:
    """ENR8: the six-column contact validation row per record (two left joins on the key)."""
    a = addr.select(F.col(key).alias("_ak"), F.col("normalized_address"), F.col("confidence").alias("address_confidence"))
    p = phone.select(F.col(key).alias("_pk"), F.col("formatted_number").alias("validated_phone"),
                     F.col("line_type").alias("phone_line_type"), F.col("carrier").alias("phone_carrier"))
    j = records.join(a, records[key] == a["_ak"], "left").join(p, records[key] == p["_pk"], "left")
    return j.select(key, "normalized_address", "address_confidence", "validated_phone", "phone_line_type",
                    "phone_carrier")
