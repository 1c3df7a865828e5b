import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Invented census records, ';'-separated, no header: empty and "" fields, a bad integer, a
# literal '?', a missing label, a category seen once, a tie, zeros beside nulls, and a
# constant column (education_num).
CENSUS_LINES = [
    "39;Private;77516;Bachelors;9;Never-married;Adm-clerical;Not-in-family;White;Male;2174;0;40;United-States;<=50K",
    "50;Self-emp;83311;Bachelors;9;Married;Exec-managerial;Husband;White;Male;0;0;13;United-States;>50K",
    "38;Private;215646;HS-grad;9;Divorced;Handlers;Not-in-family;White;Male;0;0;40;United-States;<=50K",
    ";Private;234721;11th;9;Married;Handlers;Husband;Black;Male;0;;40;United-States;<=50K",
    "28;Private;338409;Bachelors;9;Married;Prof-specialty;Wife;Black;Female;;0;40;Cuba;>50K",
    "x7;Private;284582;Masters;9;Married;Exec-managerial;Wife;White;Female;0;0;40;United-States;>50K",
    '49;Private;160187;9th;9;"";Other-service;Not-in-family;Black;Female;0;0;16;Jamaica;<=50K',
    "52;Self-emp;209642;HS-grad;9;Married;Exec-managerial;Husband;White;Male;0;1902;45;United-States;>50K",
    "31;Private;45781;Masters;9;Never-married;Prof-specialty;Not-in-family;White;Female;14084;0;50;?;>50K",
    "42;Private;159449;Bachelors;9;Married;Exec-managerial;Husband;White;Male;5178;0;40;United-States;>50K",
    "37;Private;280464;Some-college;9;Married;Exec-managerial;Husband;Black;Male;0;0;80;United-States;>50K",
    "30;State-gov;141297;Bachelors;9;Married;Prof-specialty;Husband;Asian;Male;0;0;40;India;>50K",
    "23;Private;122272;Bachelors;9;Never-married;Adm-clerical;Own-child;White;Female;0;0;30;United-States;<=50K",
    "32;Private;205019;Assoc;9;Never-married;Sales;Not-in-family;Black;Male;0;0;50;United-States;<=50K",
    "40;Private;121772;Assoc;9;Married;Craft-repair;Husband;Asian;Male;0;0;40;;>50K",
    "34;Private;245487;7th;9;Married;Transport;Husband;Other;Male;0;0;45;Mexico;",
    "25;Self-emp;176756;HS-grad;9;Never-married;Farming;Own-child;White;Male;0;0;35;United-States;<=50K",
    "32;Private;186824;HS-grad;9;Never-married;Machine-op;Unmarried;White;Male;0;0;40;United-States;<=50K",
    "38;Private;28887;11th;9;Married;Sales;Husband;White;Male;0;0;50;United-States;<=50K",
    "43;Self-emp;292175;Masters;9;Divorced;Exec-managerial;Unmarried;White;Female;0;0;45;United-States;>50K",
    "40;Private;193524;Doctorate;9;Married;Prof-specialty;Husband;White;Male;0;0;60;United-States;>50K",
    "54;Private;302146;HS-grad;9;Separated;Other-service;Unmarried;Black;Female;0;0;20;United-States;<=50K",
    "35;Federal-gov;76845;9th;9;Married;Farming;Husband;Black;Male;0;0;40;United-States;<=50K",
    "43;Private;117037;11th;9;Married;Transport;Husband;White;Male;0;2042;40;United-States;<=50K",
    "59;Private;109015;HS-grad;9;Divorced;Tech-support;Unmarried;White;Female;0;0;40;United-States;<=50K",
    "56;Local-gov;216851;Bachelors;9;Married;Tech-support;Husband;White;Male;0;0;40;United-States;>50K",
    "19;Private;168294;HS-grad;9;Never-married;Craft-repair;Own-child;White;Male;0;0;40;United-States;<=50K",
    "54;;180211;Some-college;9;Married;;Husband;Asian;Male;0;0;60;South;>50K",
    "39;Private;367260;HS-grad;9;Divorced;Exec-managerial;Not-in-family;White;Male;0;0;80;United-States;<=50K",
    "49;Private;193366;HS-grad;9;Married;Craft-repair;Husband;White;Male;0;0;40;United-States;<=50K",
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("gapwise-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def census(spark, tmp_path_factory):
    from gapwise.sources import CENSUS_SCHEMA, read_delimited

    path = tmp_path_factory.mktemp("census") / "census.csv"
    path.write_text("\n".join(CENSUS_LINES) + "\n")
    return read_delimited(spark, str(path), CENSUS_SCHEMA)


@pytest.fixture(scope="session")
def numbers(spark):
    """Keys with a null, a NaN and zeros."""
    nan = float("nan")
    return spark.createDataFrame(
        [(0, 1.0, 5), (1, None, 5), (2, nan, 5), (3, 0.0, 5), (4, 3.0, 5), (5, 0.0, None)],
        "k int, x double, same int",
    )
