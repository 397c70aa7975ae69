"""Bindings: the driver's synthetic tables given the domain shapes.

Each binding is one SQL text with ``{table}`` placeholders. Spark runs it with
``spark.sql(text, customer=df, ...)`` (the DataFrames are bound as views by
the session, so Catalyst still sees one plan and prunes/pushes into the
parquet scans); the DuckDB oracle runs the same text with plain view names.
Sharing the text means the oracle and the Spark jobs start from identical
rows, so any difference downstream is an operator difference.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Table names the driver pre-registers for the oracle.
DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]

# As-of dates used by every binding-driven query (no clock functions anywhere).
AS_OF = "2025-06-30"
EVENTS_AS_OF = "2024-01-31"

NPI_RAW = """
select case when v = 1 and c_custkey % 170 = 0 then 'N-' || cast(c_custkey as string)
    else cast(1000000000 + c_custkey as string) end as npi,
  case when c_custkey % 4 = 3 then '2' else '1' end as entity_type_code,
  case c_custkey % 6 when 0 then 'Robert' when 1 then 'Rupert' when 2 then 'Ann' when 3 then ' Anne ' when 4 then 'Jon' else 'Maria' end as first_name,
  case when c_custkey % 97 = 0 then '' when c_custkey % 10 = 0 then 'Smith' when c_custkey % 10 = 5 then 'Smyth'
    else substr('BDFGKLMNPRST', cast(1 + c_custkey % 12 as int), 1) || 'a'
      || substr('bdlmrcbdlmrc', cast(1 + floor(c_custkey / 12.0) % 12 as int), 1) || 'e'
      || substr('dlmrcbdlmrcb', cast(1 + floor(c_custkey / 144.0) % 12 as int), 1) end as last_name,
  case when c_custkey % 4 = 3 then c_name else '' end as organization_name,
  case c_nationkey % 5 when 0 then 'TX' when 1 then 'CA' when 2 then 'NY' when 3 then 'PR' else 'TX' end as practice_state,
  'City' || cast((c_custkey + 3 * v) % 11 as string) as practice_city,
  cast(75000 + c_custkey % 17 as string) || '-0001' as practice_zip,
  case when c_custkey % 19 = 0 then 'CA' else 'US' end as practice_country,
  '(512) 555-' || lpad(cast(c_custkey % 10000 as string), 4, '0') as practice_phone,
  case c_custkey % 7 when 0 then '1223G0001X' when 1 then '122300000X' when 2 then '1223X0400X' when 3 then '1223G0001X' when 4 then '101YM0800X' when 5 then '124Q00000X' else '207Q00000X' end as taxonomy_code,
  case c_custkey % 3 when 0 then 'M' when 1 then 'F' else '' end as sex_code,
  case when c_custkey % 13 = 0 then '01/02/2020' when c_custkey % 13 = 1 then ' ' end as deactivation_date,
  case when c_custkey % 23 = 0 then 'unknown' else lpad(cast(1 + c_custkey % 12 as string), 2, '0') || '/' || lpad(cast(1 + c_custkey % 28 as string), 2, '0') || '/' || cast(2001 + c_custkey % 25 as string) end as enumeration_date,
  lpad(cast(1 + (c_custkey + 5 * v) % 12 as string), 2, '0') || '/' || lpad(cast(1 + c_custkey % 28 as string), 2, '0') || '/' || cast(2010 + (c_custkey + 3 * v) % 14 as string) as last_update_date,
  cast(v as int) as version
from {customer} cross join (select 0 as v union all select 1 as v) vv
where v = 0 or c_custkey % 10 = 0
"""

TX_LICENSE_RAW = """
select case when d = 0 then '2025-06-29' else '2025-06-30' end as snapshot_date,
  c_custkey as lic_id,
  'L' || cast(case when c_custkey % 41 = 40 then c_custkey - 1 else c_custkey end as string) as lic_nbr,
  case when c_custkey % 3 = 2 then 'hygienist' else 'dentist' end as professional_type,
  cast(case (c_custkey + 3 * d * (case when c_custkey % 5 = 1 then 1 else 0 end)) % 8 when 3 then 60 when 4 then 45 when 5 then 47 when 6 then 80 when 7 then 46 else 20 end as int) as lic_sta_cde,
  case when c_custkey % 14 <> 3 then 'Status ' || cast(case (c_custkey + 3 * d * (case when c_custkey % 5 = 1 then 1 else 0 end)) % 8 when 3 then 60 when 4 then 45 when 5 then 47 when 6 then 80 when 7 then 46 else 20 end as string) end as lic_sta_desc,
  lpad(cast(1 + c_custkey % 12 as string), 2, '0') || '/' || lpad(cast(1 + c_custkey % 28 as string), 2, '0') || '/' || cast(1996 + c_custkey % 30 as string) as lic_orig_dte,
  cast(1 + (c_custkey + 2 * d * (case when c_custkey % 17 = 4 then 1 else 0 end)) % 12 as string) || '/' || cast(1 + c_custkey % 28 as string) || '/2025' as lic_expr_dte,
  case c_custkey % 6 when 0 then 'ROBERT' when 1 then 'ROBERT' when 2 then 'ANN' when 3 then 'ANNE' when 4 then 'JOHN' else 'MARIA' end as first_nme,
  case when not (c_custkey % 3 = 2 and c_custkey % 4 = 1) then case when c_custkey % 97 = 0 then '' when c_custkey % 5 = 0 then 'SMITH'
    else upper(substr('BDFGKLMNPRST', cast(1 + c_custkey % 12 as int), 1) || case when c_custkey % 7 = 1 then 'o' else 'a' end
      || substr('bdlmrcbdlmrc', cast(1 + floor(c_custkey / 12.0) % 12 as int), 1) || 'e'
      || substr('dlmrcbdlmrcb', cast(1 + floor(c_custkey / 144.0) % 12 as int), 1)) end end as last_nme,
  case when c_custkey % 3 = 2 and c_custkey % 4 = 1 then case when c_custkey % 97 = 0 then '' when c_custkey % 5 = 0 then 'SMITH'
    else upper(substr('BDFGKLMNPRST', cast(1 + c_custkey % 12 as int), 1) || case when c_custkey % 7 = 1 then 'o' else 'a' end
      || substr('bdlmrcbdlmrc', cast(1 + floor(c_custkey / 12.0) % 12 as int), 1) || 'e'
      || substr('dlmrcbdlmrcb', cast(1 + floor(c_custkey / 144.0) % 12 as int), 1)) end end as last_mne,
  cast(c_custkey % 500 as string) || case when d = 1 and c_custkey % 6 = 3 then ' New St' else ' Main St' end as address1,
  case when c_custkey % 6 = 2 then 'Elsewhere' else 'City' || cast(c_custkey % 11 as string) end as city,
  case c_nationkey % 5 when 0 then 'TX' when 1 then 'CA' when 2 then 'NY' when 3 then 'PR' else 'TX' end as state,
  cast(case when c_custkey % 9 = 5 then 99999 else 75000 + c_custkey % 17 end as string) as zip,
  case when c_custkey % 37 = 0 and d = 1 then null else 'COUNTY' || cast((c_custkey + d * (case when c_custkey % 16 = 2 then 1 else 0 end)) % 9 as string) end as county,
  case when c_custkey % 11 = 5 and d = 1 then '01/15/2025' when c_custkey % 11 in (0, 5) then 'No Permit' when c_custkey % 11 = 1 then '03/01/2019' end as nox_permit_dte,
  case c_custkey % 13 when 1 then '02/01/2018' when 2 then 'No Permit' when 3 then '' when 4 then 'soon' end as level_1_dte,
  case c_custkey % 13 when 2 then 'No Permit' when 5 then '3/9/2019' end as level_2_dte,
  case c_custkey % 17 when 2 then 'No Permit' when 6 then '04/30/2020' end as level_3_dte,
  case when c_custkey % 12 = 7 and d = 0 then 'No Permit' when c_custkey % 12 = 7 then '05/05/2025'
    when c_custkey % 12 = 9 then '01/15/2015' when c_custkey % 12 = 3 then '' end as level_4_dte,
  case c_custkey % 9 when 0 then 'YES' when 1 then ' yes' when 2 then 'No' end as portability,
  case c_custkey % 8 when 0 then 'NO' when 1 then 'No ' when 2 then 'SHRP' end as shrp_mod,
  case c_custkey % 9 when 3 then 'NO' when 4 then 'Y' end as spp_mod,
  case c_custkey % 10 when 3 then 'Yes' when 4 then 'no' end as erx_waiver,
  case c_custkey % 11 when 3 then 'YES' when 4 then 'NO' end as level_exempt,
  case when c_custkey % 10 = 3 and d = 0 then 'No' when c_custkey % 10 = 3 then 'Yes' when c_custkey % 10 = 4 then 'YES' end as sealant,
  case c_custkey % 7 when 2 then ' yes ' when 3 then 'NO' end as nom_mod,
  case c_custkey % 8 when 5 then 'Yes' when 6 then 'no' end as lia_mod,
  case c_custkey % 15 when 1 then 'YES' when 2 then 'no' end as disc_action,
  case c_custkey % 16 when 1 then 'Yes' when 2 then 'NO' end as remedial_plns,
  case c_custkey % 5 when 0 then '' when 1 then 'n/a' when 2 then null else cast(1950 + c_custkey % 40 as string) end as birth_year,
  case c_custkey % 6 when 0 then ' ' when 1 then null else cast(1975 + c_custkey % 45 as string) end as grad_yr,
  case c_custkey % 4 when 0 then ' F ' when 1 then 'M' end as gender,
  case c_custkey % 5 when 1 then ' Lee' when 2 then '' end as middle_nme,
  case c_custkey % 18 when 1 then 'Former' end as former_last_nme,
  case c_custkey % 7 when 1 then ' State School ' end as school,
  case c_custkey % 6 when 1 then 'Suite ' || cast(c_custkey % 30 as string) end as address2,
  case c_custkey % 3 when 1 then 'USA' end as country,
  case when c_custkey % 4 <> 2 then '512555' || lpad(cast(c_custkey % 10000 as string), 4, '0') end as phone,
  case c_custkey % 5 when 1 then 'Private practice ' end as prac_desc,
  case c_custkey % 6 when 1 then cast(c_custkey as string) when 2 then 'x' end as entity_nbr,
  case c_custkey % 4 when 0 then 'GEN' when 1 then 'OMS' when 2 then '' end as prac_types
from {customer} cross join (select 0 as d union all select 1 as d) dd
where not (d = 1 and c_custkey % 29 = 7) and not (d = 0 and c_custkey % 31 = 8)
"""

# Registry rows with the organisation / credential fields the decision-maker views use
# (B1 plus: credential, DBA name, authorised official, listed licence).
NPI_RAW_FULL = NPI_RAW.replace("  cast(v as int) as version", """  case when c_custkey % 4 <> 3 then case c_custkey % 5 when 0 then 'DDS' when 1 then 'DMD' when 2 then 'D.D.S.' end end as credential,
  case when c_custkey % 8 = 7 then c_name || ' Dental' end as dba_name,
  case when c_custkey % 4 = 3 then case c_custkey % 6 when 0 then 'Robert' when 1 then 'Rupert' when 2 then 'Ann' when 3 then ' Anne ' when 4 then 'Jon' else 'Maria' end end as auth_official_first_name,
  case when c_custkey % 4 = 3 then case when c_custkey % 10 = 5 then 'Smyth'
    else substr('BDFGKLMNPRST', cast(1 + c_custkey % 12 as int), 1) || 'a'
      || substr('bdlmrcbdlmrc', cast(1 + floor(c_custkey / 12.0) % 12 as int), 1) || 'e'
      || substr('dlmrcbdlmrcb', cast(1 + floor(c_custkey / 144.0) % 12 as int), 1) end end as auth_official_last_name,
  case when c_custkey % 4 = 3 then case c_custkey % 7 when 0 then 'DDS' when 1 then 'MBA' when 2 then 'RDH' when 3 then '' when 4 then 'CEO' when 5 then 'Office Manager' end end as auth_official_credential,
  case when c_custkey % 4 = 3 then '(512) 777-' || lpad(cast(c_custkey % 10000 as string), 4, '0') end as auth_official_phone,
  case when c_custkey % 4 <> 3 and c_custkey % 3 = 0 then 'L' || cast(c_custkey as string) end as license_number,
  case when c_custkey % 4 <> 3 and c_custkey % 3 = 0 then 'TX' end as license_state,
  cast(v as int) as version""")

# Person-match API responses for the licence of each customer key (JSON text).
PERSON_RESPONSES = """
select cast(c_custkey as string) as license_id, 'L' || cast(c_custkey as string) as license_number,
  case
    when c_custkey % 13 = 0 then '{{"error": "rate limited"}}'
    when c_custkey % 11 = 0 then '{{"person": null}}'
    when c_custkey % 17 = 0 then '{{"person": {{}}}}'
    else '{{"person": {{"id": "p' || cast(c_custkey as string) || '", "email": '
      || case when c_custkey % 3 = 0 then 'null' else '"u' || cast(c_custkey as string) || '@example.com"' end
      || ', "email_status": "' || case when c_custkey % 2 = 0 then 'verified' else 'guessed' end || '"'
      || ', "linkedin_url": "https://linkedin.example/in/u' || cast(c_custkey as string) || '"'
      || ', "city": "City' || cast(c_custkey % 11 as string) || '", "state": "TX", "country": "United States"'
      || ', "phone_numbers": ' || case c_custkey % 4
           when 0 then '[]'
           when 1 then '[{{"type": "mobile", "sanitized_number": "+1512' || lpad(cast(c_custkey % 10000000 as string), 7, '0') || '"}}]'
           when 2 then '[{{"type": "work_hq", "sanitized_number": "+1214' || lpad(cast(c_custkey % 10000000 as string), 7, '0') || '"}}, {{"type": "mobile", "sanitized_number": "+1512' || lpad(cast(c_custkey % 10000000 as string), 7, '0') || '"}}, {{"type": "mobile", "sanitized_number": "+1737' || lpad(cast(c_custkey % 10000000 as string), 7, '0') || '"}}]'
           else '[{{"type": "other", "sanitized_number": "+1972' || lpad(cast(c_custkey % 10000000 as string), 7, '0') || '"}}]' end
      || ', "employment_history": ' || case when c_custkey % 5 = 0 then '[]'
           else '[{{"organization_name": "' || c_name || '", "title": "' || case c_custkey % 3 when 0 then 'Owner' when 1 then 'Office Manager' else 'Associate Dentist' end || '"}}, {{"organization_name": "Old Practice", "title": "Associate"}}]' end
      || case when c_custkey % 7 = 0 then '' else ', "organization": {{"name": "Org ' || cast(c_custkey as string) || '", "primary_domain": "org' || cast(c_custkey as string) || '.example"}}' end
      || '}}}}'
  end as response
from {customer}
"""

# Address-check API responses, one per customer key (JSON text).
ADDRESS_RESPONSES = """
select cast(1000000000 + c_custkey as string) as provider_id,
  case when c_custkey % 19 = 0 then '{{"error": "timeout"}}'
  else '{{"status": "' || case c_custkey % 5 when 0 then 'invalid' when 1 then 'unknown' else 'valid' end || '"'
    || case when c_custkey % 7 = 0 then '' else ', "deliverable": ' || case when c_custkey % 3 = 0 then 'false' else 'true' end end
    || ', "address": {{"delivery_line_1": "' || cast(c_custkey % 500 as string) || ' MAIN ST", "delivery_line_2": "'
    || case when c_custkey % 4 = 0 then 'STE ' || cast(c_custkey % 90 as string) else '' end
    || '", "city": "CITY' || cast(c_custkey % 11 as string) || '", "state": "TX", "zip": "'
    || cast(75000 + c_custkey % 17 as string) || '", "zip4": "0001"}}'
    || ', "metadata": {{"dpv_match": "' || case when c_custkey % 2 = 0 then 'Y' else 'N' end || '"'
    || case when c_custkey % 6 = 0 then '' else ', "confidence": 0.' || cast(50 + c_custkey % 50 as string) end
    || ', "dpv_footnotes": ["AA", "BB"]}}}}'
  end as response
from {customer}
"""

# Phone-check API responses, one per customer key (JSON text).
PHONE_RESPONSES = """
select cast(1000000000 + c_custkey as string) as provider_id,
  '{{"phone_number": "+1512555' || lpad(cast(c_custkey % 10000 as string), 4, '0') || '"'
  || ', "national_format": "(512) 555-' || lpad(cast(c_custkey % 10000 as string), 4, '0') || '"'
  || ', "country_code": "US", "valid": ' || case when c_custkey % 9 = 0 then 'false' else 'true' end
  || case c_custkey % 3 when 0 then ', "line_type_intelligence": {{"type": "mobile", "carrier_name": "Carrier A"}}'
       when 1 then ', "line_type_intelligence": {{}}, "carrier": {{"name": "Carrier B", "type": "landline"}}'
       else '' end
  || '}}' as response
from {customer}
"""

# State-board JSON records (Washington, Colorado, Florida) and a Texas ETN extract, one per customer key.
WA_RECORDS = """
select cast(c_custkey as string) as record_id,
  '{{"credentialnumber": "WA' || cast(c_custkey as string) || '", "credentialtype": "'
  || case c_custkey % 6 when 0 then 'Dentist License' when 1 then 'Dental Hygiene License'
       when 2 then 'Dental Assistant Registration' when 3 then 'Expanded Function Dental Auxiliary'
       when 4 then 'Denturist License' else 'Pharmacist License' end
  || '", "status": "' || case when c_custkey % 3 = 1 then 'EXPIRED' else 'ACTIVE' end
  || '", "firstname": "F' || cast(c_custkey % 50 as string) || '", "lastname": "' || c_name
  || '", "birthyear": "' || cast(1950 + c_custkey % 50 as string) || '", "firstissuedate": "'
  || case when c_custkey % 13 = 0 then '' when c_custkey % 10 = 0 then '2020015'
       else cast(2000 + c_custkey % 25 as string) || lpad(cast(1 + c_custkey % 12 as string), 2, '0') || lpad(cast(1 + c_custkey % 28 as string), 2, '0') end
  || '", "expirationdate": "2026' || lpad(cast(1 + c_custkey % 12 as string), 2, '0') || '15"'
  || case when c_custkey % 7 = 0 then ', "actiontaken": "Yes"' when c_custkey % 7 = 1 then '' else ', "actiontaken": "No"' end
  || '}}' as record
from {customer}
"""

CO_RECORDS = """
select cast(c_custkey as string) as record_id,
  '{{"licensenumber": "CO' || cast(c_custkey as string) || '", "licensetype": "'
  || case c_custkey % 6 when 0 then 'DEN' when 1 then 'T-DEN' when 2 then 'MSDEN' when 3 then 'DH' when 4 then 'T-DH' else 'RPH' end
  || '", "licensestatusdescription": "' || case when c_custkey % 4 = 1 then 'Expired' else 'Active' end
  || '", "firstname": "F' || cast(c_custkey % 50 as string) || '", "lastname": "' || c_name
  || '", "city": "City' || cast(c_custkey % 11 as string) || '", "state": "CO", "mailzipcode": "80' || lpad(cast(c_custkey % 1000 as string), 3, '0')
  || '", "licensefirstissuedate": "' || cast(2000 + c_custkey % 25 as string) || '-08-05T00:00:00.000"'
  || ', "licenseexpirationdate": "2026-05-31T00:00:00.000"'
  || case when c_custkey % 5 = 0 then '' else ', "linktoverifylicense": {{"url": "https://verify.example/CO' || cast(c_custkey as string) || '"}}' end
  || '}}' as record
from {customer}
"""

FL_RECORDS = """
select cast(c_custkey as string) as record_id,
  '{{"LicenseNumber": "FL' || cast(c_custkey as string) || '", "Name": "'
  || case c_custkey % 5 when 0 then upper(c_name) when 1 then upper(c_name) || ', ANN' when 2 then '' else upper(c_name) || ', ANN MARIE LEE' end
  || '", "City": "MIAMI", "State": "FL", "ZipCode": "33' || lpad(cast(c_custkey % 1000 as string), 3, '0') || '", "County": "DADE"'
  || ', "Status": "' || case c_custkey % 6 when 0 then 'Clear/Active' when 1 then 'Active' when 2 then 'Expired' when 3 then 'Null and Void' when 4 then 'Retired' else 'Delinquent' end
  || '", "OriginalIssueDate": "01/0' || cast(1 + c_custkey % 9 as string) || '/2010", "ExpirationDate": "02/28/2026"}}' as record
from {customer}
"""

TX_ETN_RAW = """
select 'E' || cast(c_custkey as string) as lic_nbr, cast(case when c_custkey % 3 = 0 then 20 else 45 end as int) as lic_sta_cde,
  case when c_custkey % 3 = 0 then 'Active' else 'Expired' end as lic_sta_desc,
  case when c_custkey % 8 = 0 then 'n/a' else lpad(cast(1 + c_custkey % 12 as string), 2, '0') || '/01/2024' end as rank_efct_dte,
  case when c_custkey % 2 = 0 then 'YES' else 'no' end as erx_waiver
from {customer}
"""

# A contact import list (names, state, e-mail, phone, profile, title), one contact per customer.
CONTACT_IMPORT = """
select 'imp' || cast(c_custkey as string) as import_id,
  case c_custkey % 6 when 0 then 'ROBERT' when 1 then 'RUPERT' when 2 then 'ANN' when 3 then 'ANNE' when 4 then 'JON' else 'MARIA' end as first_name,
  case when c_custkey % 10 = 0 then 'SMITH' when c_custkey % 10 = 5 then 'SMYTH'
    else upper(substr('BDFGKLMNPRST', cast(1 + c_custkey % 12 as int), 1) || 'a'
      || substr('bdlmrcbdlmrc', cast(1 + floor(c_custkey / 12.0) % 12 as int), 1) || 'e'
      || substr('dlmrcbdlmrcb', cast(1 + floor(c_custkey / 144.0) % 12 as int), 1)) end as last_name,
  case c_nationkey % 5 when 0 then 'TX' when 1 then 'CA' when 2 then 'NY' when 3 then 'PR' else 'TX' end as state,
  case when c_custkey % 2 = 0 then 'dr' || cast(c_custkey as string) || '@gmail.com'
       else 'office' || cast(c_custkey as string) || '@practice' || cast(c_custkey % 97 as string) || '.example' end as email,
  '(512) 444-' || lpad(cast(c_custkey % 10000 as string), 4, '0') as phone,
  'https://linkedin.example/in/c' || cast(c_custkey as string) as linkedin_url,
  case c_custkey % 3 when 0 then 'Owner' when 1 then 'Associate Dentist' else 'Office Manager' end as title
from {customer}
"""

# Texas dental-assistant and dental-lab extracts (one combined raw table) from supplier keys.
TX_OTHER_RAW = """
select cast(s_suppkey as bigint) as lic_id, 'A' || cast(s_suppkey as string) as lic_nbr,
  case when s_suppkey % 2 = 0 then 'dental_assistant' else 'dental_lab' end as professional_type,
  cast(case s_suppkey % 9 when 0 then 20 when 1 then 46 when 2 then 71 when 3 then 27 when 4 then 80 when 5 then 47
    when 6 then 65 when 7 then 45 else 70 end as int) as lic_sta_cde,
  lpad(cast(1 + s_suppkey % 12 as string), 2, '0') || '/15/' || cast(2000 + s_suppkey % 20 as string) as lic_orig_dte,
  cast(1 + s_suppkey % 12 as string) || '/1/2026' as lic_expr_dte,
  case when s_suppkey % 2 = 0 then 'PAT' end as first_nme, case when s_suppkey % 2 = 0 then upper(s_name) end as last_nme,
  cast(s_suppkey % 300 as string) || ' Oak St' as address1, 'City' || cast(s_suppkey % 11 as string) as city,
  'TX' as state, cast(75000 + s_suppkey % 17 as string) as zip, 'COUNTY' || cast(s_suppkey % 9 as string) as county,
  case s_suppkey % 3 when 0 then 'YES' when 1 then 'no' end as nom_mod,
  case when s_suppkey % 4 = 0 then 'Yes' else 'No' end as disc_action,
  case when s_suppkey % 2 = 1 then ' ' || s_name || ' Lab' end as lab_nme,
  case s_suppkey % 6 when 1 then 'Owner ' || cast(s_suppkey as string) when 2 then 'not a lab' end as lab_owner,
  case s_suppkey % 6 when 3 then 'Manager' end as lab_manager,
  case s_suppkey % 10 when 5 then 'CDT-' || cast(s_suppkey as string) end as lab_cdt,
  case s_suppkey % 4 when 1 then 'Commercial ' when 3 then 'In office' end as lab_type
from {supplier}
"""

STATE_LOG = """
select user_id, ts, event_id, event_type from {events}
"""

TOUCHPOINTS = """
select event_id, cast(user_id as string) as lead_id, ts as event_timestamp,
  case event_type when 'view' then 'page_view' when 'click' then 'email_click' when 'signup' then 'form_submit' when 'purchase' then 'deal_won' else 'email_sent' end as event_type,
  case user_id % 4 when 0 then 'email' when 1 then 'display' when 2 then 'organic' else 'direct' end as channel,
  'camp' || cast(event_id % 12 as string) as campaign_id, props as event_metadata
from {events}
"""

ENRICHMENTS = """
select cast(1000000000 + c_custkey as string) as provider_id, s.source,
  case when (c_custkey + s.o) % 4 = 0 then null else '512' || lpad(cast(c_custkey % 10000 + s.o as string), 7, '0') end as phone,
  case when s.source = 'npi' or (c_custkey + s.o) % 3 = 0 then null else lower(s.source) || cast(c_custkey as string) || '@example.com' end as email,
  case when s.source in ('wiza', 'apollo') and c_custkey % 2 = 0 then 'https://example.com/in/' || s.source || cast(c_custkey as string) end as linkedin_url,
  case when s.source in ('scraped', 'apollo') and c_custkey % 5 <> 0 then 'https://' || s.source || cast(c_custkey as string) || '.example.com' end as website,
  case when (c_custkey + s.o) % 6 <> 0 then c_name || ' ' || s.source end as company_name,
  case when s.source in ('wiza', 'apollo') then case c_custkey % 4 when 0 then 'Owner' when 1 then 'Office Manager' when 2 then 'CFO' else 'Associate' end end as title,
  cast(case when s.source = 'apollo' then 1 + c_custkey % 60 end as int) as employee_count,
  cast('2025-01-' || lpad(cast(1 + (c_custkey + s.o) % 28 as string), 2, '0') as date) as enriched_at
from {customer} cross join (select 'apollo' as source, 0 as o union all select 'wiza', 1 union all select 'scraped', 2 union all select 'npi', 3 union all select 'apollo', 4) s
where c_custkey % (s.o + 2) <> 1 and (s.o < 4 or c_custkey % 30 = 0)
"""

EXPORT_QUEUE = """
select cast(o_orderkey as string) as export_id, cast(1000000000 + o_custkey as string) as provider_id,
  case o_orderkey % 5 when 0 then 'ghl' when 1 then 'instantly' when 2 then 'lob_postcard' when 3 then 'lob_letter' else 'webhook' end as destination,
  case o_orderkey % 6 when 0 then 'queued' when 1 then 'approved' when 2 then 'scheduled' when 3 then 'sent' when 4 then 'failed' else 'cancelled' end as status,
  'load' || cast(o_orderkey % 40 as string) as data_load_id, cast(50 + o_orderkey % 50 as int) as match_confidence,
  'user' || cast(o_custkey as string) || '@example.com' as email, 'L' || cast(o_custkey as string) as license_number,
  o_orderdate as queued_at
from {orders}
"""

SUPPRESSION = """
select cast(s_suppkey as string) as suppression_id,
  case when s_suppkey % 3 = 0 then 'USER' || cast(s_suppkey * 7 as string) || '@EXAMPLE.COM' end as email,
  case when s_suppkey % 3 = 1 then 'L' || cast(s_suppkey * 5 as string) end as license_number,
  case when s_suppkey % 3 = 2 then cast(1000000000 + s_suppkey * 3 as string) end as npi,
  case s_suppkey % 4 when 0 then 'ghl' when 1 then 'instantly' end as destination,
  s_suppkey % 10 <> 9 as is_active,
  case when s_suppkey % 6 = 0 then cast('2020-01-01' as date) end as expires_at
from {supplier}
"""

# Loads registry: distinct data_load_id of the export queue, status by id % 4.
DATA_LOADS = """
select load_id, status, validation_passed, source_type, state_code, row_count, row_count_delta_pct,
  loaded_at, cast(loaded_at as date) as source_date,
  case when status in ('validated', 'promoted') then loaded_at + interval 1 hour * (n % 48) end as validated_at,
  24 as promotion_delay_hours
from (
  select data_load_id as load_id, cast(substr(data_load_id, 5) as int) as n,
    case cast(substr(data_load_id, 5) as int) % 4 when 0 then 'promoted' when 1 then 'validated' when 2 then 'quarantined' else 'pending' end as status,
    case when cast(substr(data_load_id, 5) as int) % 4 = 1 then cast(substr(data_load_id, 5) as int) % 3 <> 2 end as validation_passed,
    'tx_' || case cast(substr(data_load_id, 5) as int) % 2 when 0 then 'dentist' else 'hygienist' end as source_type,
    'TX' as state_code,
    cast(1000 + cast(substr(data_load_id, 5) as int) * 37 as bigint) as row_count,
    cast(cast(substr(data_load_id, 5) as int) * 7 - 140 as double) / 1000 as row_count_delta_pct,
    cast('2025-06-01' as timestamp) + interval 1 day * (cast(substr(data_load_id, 5) as int) % 30) + interval 1 hour * (cast(substr(data_load_id, 5) as int) % 24) as loaded_at
  from (select distinct data_load_id from ({export_queue}) q) l
) x
"""

# Export history: the sent rows of the queue, sent one day after queueing.
EXPORT_HISTORY = """
select md5(export_id || '-sent') as history_id, export_id, provider_id, destination, data_load_id,
  queued_at + interval 1 day as sent_at,
  case when cast(export_id as bigint) % 7 = 0 then 'bounced' when cast(export_id as bigint) % 11 = 0 then 'complained' else 'delivered' end as delivery_status,
  email, license_number
from ({export_queue}) q where status = 'sent'
"""

BINDINGS = {
    "npi_raw": (NPI_RAW, ["customer"]),
    "npi_raw_full": (NPI_RAW_FULL, ["customer"]),
    "person_responses": (PERSON_RESPONSES, ["customer"]),
    "wa_records": (WA_RECORDS, ["customer"]),
    "tx_other_raw": (TX_OTHER_RAW, ["supplier"]),
    "contact_import": (CONTACT_IMPORT, ["customer"]),
    "co_records": (CO_RECORDS, ["customer"]),
    "fl_records": (FL_RECORDS, ["customer"]),
    "tx_etn_raw": (TX_ETN_RAW, ["customer"]),
    "address_responses": (ADDRESS_RESPONSES, ["customer"]),
    "phone_responses": (PHONE_RESPONSES, ["customer"]),
    "tx_license_raw": (TX_LICENSE_RAW, ["customer"]),
    "state_log": (STATE_LOG, ["events"]),
    "touchpoints": (TOUCHPOINTS, ["events"]),
    "enrichments": (ENRICHMENTS, ["customer"]),
    "export_queue": (EXPORT_QUEUE, ["orders"]),
    "suppression_list": (SUPPRESSION, ["supplier"]),
}


def file_size(spark: SparkSession, path: str) -> int:
    """Bytes of one file, by the file system that Spark's readers use."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(file).getLen()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The shared texts fan rows out with ``cross join (select .. union all select ..)``
# against a literal of 2 or 5 rows; Spark would plan that as a nested-loop join.
# The Spark side uses the equivalent generator instead (one Generate node, no
# join); the DuckDB oracle keeps the shared text, so the gate proves both agree.
_SPARK_FANOUT = [
    ("cross join (select 0 as v union all select 1 as v) vv", "lateral view explode(array(0, 1)) vv as v"),
    ("cross join (select 0 as d union all select 1 as d) dd", "lateral view explode(array(0, 1)) dd as d"),
    ("cross join (select 'apollo' as source, 0 as o union all select 'wiza', 1 union all select 'scraped', 2 "
     "union all select 'npi', 3 union all select 'apollo', 4) s",
     "lateral view inline(array(struct('apollo' as source, 0 as o), struct('wiza' as source, 1 as o), "
     "struct('scraped' as source, 2 as o), struct('npi' as source, 3 as o), struct('apollo' as source, 4 as o))) "
     "s as source, o"),
]


# Literal timestamps are zone-free in DuckDB; Spark's TIMESTAMP is zone-aware, so the
# Spark side types them TIMESTAMP_NTZ (no dependence on the session time zone).
_SPARK_TYPES = [("cast('2025-06-01' as timestamp)", "cast('2025-06-01' as timestamp_ntz)")]


def spark_text(name: str) -> str:
    text = BINDINGS[name][0]
    for shared, spark_form in _SPARK_FANOUT + _SPARK_TYPES:
        text = text.replace(shared, spark_form)
    return text


_BOUND: dict = {}


def binding(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Return binding ``name`` as a DataFrame over the parquet files in ``sf_dir`` (memoised per session)."""
    key = (id(spark), sf_dir, name)
    hit = _BOUND.get(key)
    if hit is not None and hit[0] is spark:
        return hit[1]
    df = _binding(spark, sf_dir, name)
    _BOUND[key] = (spark, df)
    return df


def _binding(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _, tables = BINDINGS[name]
    frames = {t: read_table(spark, sf_dir, t) for t in tables}
    if name in WIDENED:
        frames = {t: spread(df, WIDENED[name]) for t, df in frames.items()}
    return spark.sql(spark_text(name), **frames)


#: Bindings that make several wide rows of each narrow one, and the bytes of input that a task is to widen: a
#: file split of 128 MB, or a file of one row group, would be millions of wide rows in one task.
WIDENED = {"tx_license_raw": 1 << 20}


def spread(df: DataFrame, bytes_per_task: int) -> DataFrame:
    """The rows dealt over tasks by the size of their files; as they are where that is one task's."""
    tasks = -(-sum(file_size(df.sparkSession, f) for f in df.inputFiles()) // bytes_per_task)
    return df.repartition(tasks) if tasks > 1 else df


def data_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = DATA_LOADS
    for shared, spark_form in _SPARK_TYPES:
        text = text.replace(shared, spark_form)
    return spark.sql(text, export_queue=binding(spark, sf_dir, "export_queue"))


def export_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(EXPORT_HISTORY, export_queue=binding(spark, sf_dir, "export_queue"))


def sql_cte(*names: str) -> str:
    """``WITH`` clause defining the named bindings over the driver's views (oracle side)."""
    parts = []
    for n in names:
        if n == "data_loads":
            text = DATA_LOADS.format(export_queue="select * from export_queue")
        elif n == "export_history":
            text = EXPORT_HISTORY.format(export_queue="select * from export_queue")
        else:
            text, tables = BINDINGS[n]
            text = text.format(**{t: t for t in tables})
        parts.append(f"{n} as ({text.strip()})")
    return "with " + ",\n".join(parts) + "\n"


def flat(sql: str) -> str:
    """Collapse whitespace (oracle strings are easier to read in reports)."""
    return re.sub(r"\s+", " ", sql).strip()
