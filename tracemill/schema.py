"""Schemas and fixed lists of the trace format."""

#: Property names with a column of their own, in the order of the columns.
HOT = {
    "process": "process", "process_name": "p:processName", "os_thread": "OSThread", "connect_id": "t:connectID", "session_id": "SessionID",
    "usr": "Usr", "app_name": "t:applicationName", "computer_name": "t:computerName", "app_id": "AppID", "dbms": "DBMS", "db_name": "DataBase",
    "db_pid": "dbpid", "trans": "Trans", "rows_ret": "Rows", "rows_affected": "RowsAffected", "cpu_time_us": "CpuTime", "memory": "Memory",
    "memory_peak": "MemoryPeak", "in_bytes": "InBytes", "out_bytes": "OutBytes", "call_wait_us": "callWait", "iface_name": "IName",
    "method_name": "MName", "func_name": "Func", "module": "Module", "context": "Context", "plan_text": "planSQLText", "exception": "Exception",
    "lock_regions": "Regions", "lock_wait_conns": "WaitConnections", "locks_dump": "Locks", "deadlock_graph": "DeadlockConnectionIntersections",
}
#: Columns that take the first non-empty of several properties.
FIRST_OF = {"client_id": ("t:clientID", "ClientID"), "sql_text": ("Sql", "Query", "Sdbl"), "descr": ("Descr", "Txt", "txt")}
#: How hot columns are typed (all others are text).
TYPED = {
    "u64": ("rows_ret", "rows_affected", "cpu_time_us", "in_bytes", "out_bytes", "call_wait_us"),
    "u32": ("os_thread", "client_id", "connect_id", "session_id", "db_pid"),
    "u8": ("trans",),
    "i64": ("memory", "memory_peak"),
}
#: Names of the record itself; they have columns too.
RECORD = ("timestamp", "duration", "event", "level", "filename", "file_path")
#: Properties that are text even if they look like numbers.
ALWAYS_TEXT = ("SearchString", "Guid", "UUID")
#: Event types of the database and of locks.
DATABASE = ("DBMSSQL", "DBPOSTGRS", "DBORACLE", "DB2")
LOCKS = ("TLOCK", "TTIMEOUT", "TDEADLOCK")

IN_COLUMNS = (*RECORD, *HOT.values(), *[n for names in FIRST_OF.values() for n in names])
PROPERTIES = "array<struct<name:string,value:string,quoted:boolean>>"
RAW = f"file_path string, filename string, start_off long, end_off long, timestamp string, duration string, event string, level string, props {PROPERTIES}"
