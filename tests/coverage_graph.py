"""The call graph of the library, and the table of coverage that follows from it.

Run as a module, it writes the last column of COVERAGE.md anew: the registered
queries that reach a row's functions, or else the tests that do.
"""

from __future__ import annotations

import ast
import re
from collections import defaultdict
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
PACKAGE = ROOT / "folioscale"
NOTHING = "no query or test of its own"


def _module(path: Path) -> str:
    return path.relative_to(PACKAGE).with_suffix("").as_posix()


class Graph:
    """Functions and methods as 'module.name' or 'module.Class.name', with what each refers to."""

    def __init__(self, paths: list[Path], name=_module):
        self.trees = {name(p): ast.parse(p.read_text()) for p in paths}
        self.bodies: dict[str, ast.AST] = {}
        self.methods: dict[str, list[str]] = defaultdict(list)
        for m, tree in self.trees.items():
            for node in tree.body:
                if isinstance(node, ast.FunctionDef):
                    self.bodies[f"{m}.{node.name}"] = node
                elif isinstance(node, ast.ClassDef):
                    self.bodies[f"{m}.{node.name}"] = ast.Pass()
                    for f in node.body:
                        if isinstance(f, ast.FunctionDef):
                            self.bodies[f"{m}.{node.name}.{f.name}"] = f
                            self.methods[f.name].append(f"{m}.{node.name}.{f.name}")

    def imports(self, module: str, package: str | None = None) -> dict[str, str]:
        """Local names of the library's modules and functions, as seen in a module."""
        out: dict[str, str] = {}
        for node in ast.walk(self.trees[module]):
            if isinstance(node, ast.ImportFrom):
                base = module.split("/")[: -node.level] if node.level and package is None else []
                parts = (node.module or "").split(".") if node.module else []
                if package is not None:
                    if parts[:1] != [package]:
                        continue
                    parts = parts[1:]
                elif not node.level:
                    continue
                for a in node.names:
                    out[a.asname or a.name] = "/".join([*base, *parts, a.name])
        return out

    def refers(self, key: str, graph: Graph | None = None, package: str | None = None) -> set[str]:
        graph = graph or self
        module = key.split(".")[0]
        seen, known = set(), self.imports(module, package)
        for node in ast.walk(self.bodies[key]):
            if isinstance(node, ast.Name):
                seen.add(f"{module}.{node.id}")
                if node.id in known:
                    head, _, tail = known[node.id].rpartition("/")
                    seen.add(f"{head}.{tail}")
            elif isinstance(node, ast.Attribute):
                if isinstance(node.value, ast.Name) and node.value.id in known:
                    seen.add(f"{known[node.value.id]}.{node.attr}")
                elif not (isinstance(node.value, ast.Name) and node.value.id in ("F", "T", "np", "pa", "pd", "re", "json")):
                    # a method: only of classes that the module knows
                    classes = {f"{known[n].rpartition('/')[0]}.{known[n].rpartition('/')[2]}" for n in known} | {f"{module}.{n}" for n in ("Catalog",)}
                    seen |= {x for x in graph.methods.get(node.attr, ()) if x.rpartition(".")[0] in classes or x.split(".")[0] in {module, *known.values()}}
        return {s for s in seen if s in graph.bodies}

    def reach(self, start: set[str]) -> set[str]:
        done, todo = set(), list(start)
        while todo:
            key = todo.pop()
            if key not in done:
                done.add(key)
                todo += self.refers(key)
                if key.count(".") == 1 and isinstance(self.bodies[key], ast.Pass) and f"{key}.__init__" in self.bodies:
                    todo.append(f"{key}.__init__")
        return done


def library() -> Graph:
    return Graph([p for p in sorted(PACKAGE.rglob("*.py")) if "llm" not in p.parts and p.name != "__init__.py"])


def by_queries(graph: Graph) -> dict[str, set[str]]:
    """What each registered query reaches."""
    from folioscale import catalogue

    names = set(catalogue.queries())
    return {k.split(".")[1]: graph.reach({k}) for k in graph.bodies if k.startswith("plans/registered_") and k.count(".") == 1 and k.split(".")[1] in names}


def by_tests(graph: Graph) -> dict[str, set[str]]:
    """What each test outside the subpackage reaches through names of the library."""
    found = Graph(sorted((ROOT / "tests").glob("test_*.py")), lambda p: p.stem)
    out = {}
    for k in found.bodies:
        if k.split(".")[-1].startswith("test_"):
            own = {k} | {x for x in found.refers(k) if x.split(".")[0] == k.split(".")[0]}
            out[k.split(".")[-1]] = graph.reach(set().union(*[found.refers(x, graph, "folioscale") for x in own]))
    return out


def rows() -> list[tuple[str, list[str], str]]:
    """(number, cited functions, last column) of the table."""
    out = []
    for line in (ROOT / "COVERAGE.md").read_text().splitlines():
        cells = [c.strip() for c in line.strip("|").split(" | ")]
        if len(cells) == 4 and cells[0].strip().isdigit() and not cells[2].startswith("—"):
            out.append((cells[0].strip(), re.findall(r"`([^`]+)`", cells[2]), cells[3].rstrip(" |")))
    return out


def evidence(functions: list[str], queries: dict[str, set[str]], tests: dict[str, set[str]]) -> str:
    """Few queries, those that reach least besides first, that reach as many of the functions as any do; then tests for the rest."""
    open_, said = set(functions), []
    for found, show in ((queries, "`{}`"), (tests, "test `{}`")):
        while open_:
            best = max(found, key=lambda n: (len(open_ & found[n]), -len(found[n]), n))
            if not open_ & found[best]:
                break
            said.append(show.format(best))
            open_ -= found[best]
    if not said:
        return NOTHING
    return ", ".join(said) + (f"; nothing reaches {', '.join(f'`{f}`' for f in functions if f in open_)}" if open_ else "")


def main() -> None:
    graph = library()
    queries, tests = by_queries(graph), by_tests(graph)
    wanted = {n: evidence(f, queries, tests) for n, f, _ in rows()}
    out = []
    for line in (ROOT / "COVERAGE.md").read_text().splitlines():
        cells = line.strip().strip("|").split(" | ")
        n = cells[0].strip()
        if len(cells) == 4 and n in wanted:
            line = "|" + " | ".join(cells[:3]) + f" | {wanted[n]} |"
            line = line if line.startswith("| ") else "| " + line[1:].lstrip()
        out.append(line)
    (ROOT / "COVERAGE.md").write_text("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
