"""first_seen: a group holds many keys, and its state is read and added to once per batch."""

from types import SimpleNamespace as NS

from pyspark.sql import Row

from millrace.streaming import processors


class _List:
    def __init__(self):
        self.items, self.calls = [], 0

    def exists(self):
        return bool(self.items)

    def get(self):
        self.calls += 1
        return iter(list(self.items))

    def appendList(self, items):
        self.calls += 1
        self.items.extend(items)


def test_one_group_passes_the_least_row_of_each_new_key_with_one_read_and_one_write():
    state = _List()
    machine = processors.FirstSeen(60_000, ["request", "value"])
    machine.init(NS(getListState=lambda *args: state))
    clock = NS(getCurrentProcessingTimeInMs=lambda: 100)
    rows = [Row(request=f"r{i % 50}", value=i) for i in range(200, -1, -1)]
    out = list(machine.handleInputRows((7,), iter(rows), clock))
    assert sorted((r.request, r.value) for r in out) == sorted((f"r{i}", i) for i in range(50))
    assert state.calls == 1 and len(state.items) == 50
    again = list(machine.handleInputRows((7,), iter([Row(request="r3", value=0), Row(request="r99", value=5)]), clock))
    assert [(r.request, r.value) for r in again] == [("r99", 5)]
    assert state.calls == 3
