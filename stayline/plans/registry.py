"""All registered queries and their SQL."""

from stayline.plans import business, evaluation, featuring, intake, learning, live, monitoring

SECTIONS = [intake, featuring, evaluation, monitoring, business, live, learning]


def queries():
    return {name: f for section in SECTIONS for name, f in section.QUERIES.items()}


def oracle_sql():
    return {name: q for section in SECTIONS for name, q in section.ORACLE.items()}
