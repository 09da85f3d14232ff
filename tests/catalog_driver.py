"""A DB-API driver that knows one answer: the columns of the source tables."""

paramstyle = "format"

COLUMNS = {
    "public": [
        ("orders", 1, "id", "integer"),
        ("orders", 2, "total", "numeric(10,2)"),
        ("orders", 3, "note", "character varying"),
        ("orders", 4, "updated_at", "timestamp without time zone"),
        ("people", 1, "id", "uuid"),
        ("people", 2, "born", "date"),
    ]
}
#: Statements that were run.
ASKED = []


class Cursor:
    description = (("table_name",), ("ordinal_position",), ("column_name",), ("data_type",))

    def execute(self, sql, parameters):
        assert "information_schema.columns" in sql and sql.count("%s") == len(parameters)
        ASKED.append(sql)
        self.left = list(COLUMNS.get(*parameters, []))

    def fetchmany(self, size):
        out, self.left = self.left[:size], self.left[size:]
        return out


class Connection:
    def cursor(self):
        return Cursor()

    def close(self):
        pass


def connect():
    return Connection()
