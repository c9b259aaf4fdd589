"""Schemas of the inputs that arrive as text."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B = T.StringType(), T.DoubleType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# A record of a nested dump. Two fields are sometimes text and sometimes objects; read as text,
# the JSON reader hands objects over unparsed.
NESTED_POSTING = struct(
    name=S, position=struct(name=S), text=S, orgCompany=struct(name=S),
    orgAddress=struct(companyName=S, addressLine=S, formatted=S, countryCode=S),
    json=struct(schemaOrg=struct(hiringOrganization=S)),
    sourceCC=S, dateCreated=S, url=S, source=S, locale=S, idInSource=S, seq=T.LongType(),
)

# One landed result page of a live feed.
LIVE_PAGE = struct(
    query=S, page=T.IntegerType(), error=B,
    results=T.ArrayType(struct(
        seq=T.LongType(), title=S, company=struct(display_name=S), location=struct(display_name=S),
        salary_min=D, salary_max=D, description=S, redirect_url=S, created=S, contract_type=S, contract_time=S,
    )),
)

CANONICAL = struct(
    job_id=S, title=S, company=S, location=S, country=S, salary_min=D, salary_max=D, description=S,
    skills=T.ArrayType(S), url=S, source=S, posted_date=S,
)

PROFILE_PAYLOAD = struct(
    profile_id=T.LongType(), name=S, resume_text=S, skills=T.ArrayType(S), roles=T.ArrayType(S),
    locations=T.ArrayType(S), preferred_locations=T.ArrayType(S), base_weights=T.MapType(S, D),
    min_salary=D, dealbreakers=T.ArrayType(S), max_years_required=T.IntegerType(),
    education=T.ArrayType(S), experience=T.ArrayType(S), projects=T.ArrayType(S), publications=T.ArrayType(S),
    education_first=B, emphasis=T.ArrayType(S), skills_first=B, contact=S,
)
