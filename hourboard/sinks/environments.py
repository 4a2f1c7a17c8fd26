"""Which table each environment loads."""

from dataclasses import dataclass

TABLE_NAME = "signage_impressions"

# Target database of each environment.
DATABASES = {
    "development": "sg_reports_tmp",
    "staging": "sg_reports_staging",
    "production": "sg_reports_production",
}


@dataclass(frozen=True)
class Environment:
    database: str
    table: str = TABLE_NAME
    catalog: str | None = None

    @property
    def target(self) -> str:
        """Name of the target table, qualified as far as the environment says."""
        return ".".join(filter(None, (self.catalog, self.database, self.table)))

    def qualify(self, name: str) -> str:
        """Fill in what a one- or two-part table name leaves out; three parts stand as given."""
        parts = name.split(".")
        if len(parts) > 3 or not all(parts):
            raise ValueError(f"Not a table name: {name}")
        if len(parts) == 1:
            parts.insert(0, self.database)
        if len(parts) == 2 and self.catalog:
            parts.insert(0, self.catalog)
        return ".".join(parts)


def get_environment(
    name: str | None = None, catalog: str | None = None, database: str | None = None
) -> Environment:
    """Environment by name, development when none is given; ``database`` stands instead of its own."""
    name = name or "development"
    if database:
        return Environment(database, catalog=catalog)
    if name not in DATABASES:
        raise ValueError(f"Unknown environment: {name}")
    return Environment(DATABASES[name], catalog=catalog)
