"""Column types of the stored tables and of the files exchanged between steps,
as DDL text."""

JOBS = (
    "job_id string, source string, job_source_id string, country string, "
    "job_title string, company_name string, job_url string, "
    "job_description string, posted_date date, created_at timestamp_ntz, "
    "skill_extraction_date timestamp_ntz"
)
JOBS_KEY = ["source", "job_source_id"]

# The older table layout, filled by the page-selector and listing readers.
LEGACY_JOBS = (
    "job_id string, source string, job_title string, company_name string, "
    "location string, job_description string, posted_date date, job_url string, "
    "job_type string, scraped_date date, created_at timestamp_ntz, "
    "updated_at timestamp_ntz"
)
LEGACY_JOBS_KEY = ["job_url"]

SKILLS = (
    "skill_id string, skill_name string, category string, tags array<string>, "
    "variants array<string>, created_at timestamp_ntz"
)

JOB_SKILLS = (
    "job_skill_id string, job_id string, job_title string, skill_id string, "
    "skill_name string, extraction_method string, created_at timestamp_ntz"
)

PACKAGES = (
    "package_id string, package_name string, category string, "
    "description string, created_at timestamp_ntz"
)
PACKAGE_DOWNLOADS = (
    "download_id string, package_id string, date date, downloads long, "
    "created_at timestamp_ntz"
)

# Files between parsing and loading: everything is still text.
JOBS_EXPORT = (
    "source string, job_source_id string, country string, job_title string, "
    "company_name string, job_url string, job_description string, "
    "posted_date string"
)
PAIRS_EXPORT = ("job_id string, job_title string, skill_name string")

# Append-only record of finished skill extraction, joined to jobs when read.
JOB_MARKS = ("job_id string, skill_extraction_date timestamp_ntz")

# Widest value each text column of a table takes, in characters.
JOBS_WIDTHS = {
    "source": 50,
    "job_source_id": 50,
    "country": 255,
    "job_title": 255,
    "company_name": 255,
    "job_url": 500,
}
LEGACY_JOBS_WIDTHS = {
    "source": 50,
    "job_title": 255,
    "company_name": 255,
    "location": 255,
    "job_url": 500,
    "job_type": 50,
}
LEGACY_JOBS_REQUIRED = ["source", "job_title", "job_description", "scraped_date"]
SKILLS_WIDTHS = {"skill_name": 100, "category": 50}
JOB_SKILLS_WIDTHS = {
    "job_title": 255,
    "skill_name": 100,
    "extraction_method": 50,
}
