"""The curated skill catalog as a DataFrame."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Skill name | category | tags. They decide what the matcher finds.
_ROWS = """
Python|language|general-purpose,scripting
SQL|language|query-language,standard
Scala|language|big-data,functional
Java|language|big-data,general-purpose
Golang|language|infrastructure,performance
Bash|language|scripting,automation
Spark|platform|big-data,distributed-computing
PySpark|platform|python,big-data
Hadoop|platform|big-data,distributed-computing
Hive|platform|sql-on-hadoop,big-data
Presto|platform|sql-engine,distributed-query
Trino|platform|sql-engine,distributed-query
Flink|platform|streaming,real-time
Snowflake|platform|cloud-native,data-warehouse
BigQuery|platform|cloud-native,data-warehouse
Redshift|platform|aws,data-warehouse
Azure Synapse|platform|azure,data-warehouse
Databricks|platform|lakehouse,ai-ml
PostgreSQL|platform|relational,open-source
DuckDB|platform|olap,embedded
dbt|orchestration|elt,testing,data-modeling,data-quality
Airflow|orchestration|workflow-scheduling,orchestration
Prefect|orchestration|workflow-scheduling,orchestration
Dagster|orchestration|workflow-scheduling,data-aware
Fivetran|orchestration|elt,managed-service
Airbyte|orchestration|elt,open-source
Azure Data Factory|orchestration|azure,elt,managed-service
Delta Lake|storage|lakehouse,acid-transactions
Iceberg|storage|lakehouse,schema-evolution
Hudi|storage|lakehouse,incremental-processing
Apache Avro|storage|serialization,schema-evolution
Parquet|storage|columnar,compression
Kafka|streaming|event-streaming,messaging
RabbitMQ|streaming|messaging,reliability
Pub/Sub|streaming|google-cloud,managed-service
AWS|cloud|cloud-platform
Amazon Web Services|cloud|cloud-platform
GCP|cloud|cloud-platform
Google Cloud Platform|cloud|cloud-platform
Azure|cloud|cloud-platform
S3|storage|aws,object-storage
GCS|storage|google-cloud,object-storage
Azure Data Lake|storage|azure,data-lake
MySQL|database|relational,open-source
MongoDB|database|nosql,document-database
Cassandra|database|nosql,distributed
Elasticsearch|database|search,analytics
Redis|database|nosql,in-memory,caching
DynamoDB|database|nosql,aws
SQL Server|database|relational,microsoft
Tableau|bi|visualization,enterprise
Power BI|bi|visualization,microsoft
PowerBI|bi|visualization,microsoft
Looker|bi|visualization,business-intelligence
Metabase|bi|visualization,open-source
Superset|bi|visualization,open-source
Great Expectations|tool|testing,data-quality,validation
Monte Carlo|tool|monitoring,data-quality
Docker|devops|containerization,infrastructure
Kubernetes|devops|container-orchestration,infrastructure
Terraform|devops|infrastructure-as-code,automation
Jenkins|devops|ci-cd,automation
GitHub Actions|devops|ci-cd,automation
GitLab CI|devops|ci-cd,automation
GitLabCI|devops|ci-cd,automation
CircleCI|devops|ci-cd,automation
CI/CD|devops|automation,deployment
Scikit-learn|ml|machine-learning,python
TensorFlow|ml|deep-learning,machine-learning
PyTorch|ml|deep-learning,machine-learning
XGBoost|ml|machine-learning,gradient-boosting
LightGBM|ml|machine-learning,gradient-boosting
MLOps|ml|machine-learning,infrastructure
MLflow|ml|machine-learning,experiment-tracking
Kubeflow|ml|machine-learning,orchestration
Pandas|tool|data-analysis,python
NumPy|tool|numerical-computing,python
Matplotlib|tool|visualization,python
Plotly|tool|visualization,interactive
REST|tool|api-design,standard
GraphQL|tool|api-design,modern
Protocol Buffers|tool|serialization,google
Lakehouse|platform|architecture-pattern
Data Mesh|platform|architecture-pattern
Athena|platform|aws,serverless,sql-engine
Spark SQL|platform|sql-engine,distributed
SageMaker|platform|aws,machine-learning
AWS Glue|orchestration|aws,elt,managed-service
StepFunctions|orchestration|aws,workflow-orchestration
Vertex|platform|google-cloud,machine-learning
Dataflow|platform|google-cloud,streaming,batch
Talend|orchestration|legacy,elt
Informatica|orchestration|legacy,elt
Oracle|database|legacy,relational
Teradata|platform|legacy,data-warehouse
"""


def seed_rows() -> list[tuple[str, str, list[str]]]:
    rows = (line.split("|") for line in _ROWS.strip().splitlines())
    return [(name, category, tags.split(",")) for name, category, tags in rows]


def catalog_frame(
    spark: SparkSession, rows: list[tuple[str, str, list[str]]]
) -> DataFrame:
    """Catalog rows without surface variants, ready for ``upsert_catalog``."""
    batch = spark.createDataFrame(
        rows, "skill_name string, category string, tags array<string>"
    )
    return batch.withColumn("variants", F.array().cast("array<string>"))


def seed_catalog(spark: SparkSession) -> DataFrame:
    return catalog_frame(spark, seed_rows())
