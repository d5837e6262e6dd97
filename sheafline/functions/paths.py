"""Names, ids and routing derived from a file path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, functions as F

from sheafline import fixed_values as fv
from sheafline.settings import AgentRule, as_root, default_agent_rules


def file_name(path: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(path, "/", -1)


def document_id(name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(name, fv.LAST_EXTENSION, "")


def below(path: Column, root: str, category: str) -> Column:
    """Is the file inside this category folder? The closing slash keeps
    ``CRM`` from matching ``CRM2``."""
    return path.startswith(as_root(as_root(root) + category))


def category(path: Column, root: str) -> Column:
    """First folder below the root; NULL for files lying at the root itself
    or outside it."""
    root = as_root(root)
    rest = F.substring(path, len(root) + 1, 2**31 - 1)
    name = F.substring_index(rest, "/", 1)
    inside = path.startswith(root) & (F.instr(rest, "/") > 1)
    return F.when(inside, name)


def table_slug(category: Column, slugs: Mapping[str, str] = fv.CATEGORY_SLUGS) -> Column:
    """Name used in tables: mapped, else lower case. The map is a plan literal."""
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(slugs.items())])
    return F.coalesce(F.try_element_at(known, category), F.lower(category))


def doc_path(path: Column, base: str | None = None) -> Column:
    """Folders of a file joined by ``>``: the scheme and bucket at the front and
    the file name at the back go in one regex pass. ``base`` names a leading
    folder to leave out as well, for roots that have no bucket."""
    if base:
        base = as_root(base)
        path = F.when(path.startswith(base), F.substring(path, len(base) + 1, 2**31 - 1)).otherwise(path)
    folders = F.regexp_replace(path, f"{fv.SCHEME_AND_BUCKET}|{fv.LAST_SEGMENT}", "")
    return F.translate(folders, "/", ">")


def agent(
    path: Column,
    rules: Sequence[AgentRule] | None = None,
    default: str = fv.DEFAULT_AGENT,
) -> Column:
    """Owner of a document path: the first rule whose prefix is the path or one
    of its parents. Adding the separator to both sides makes this one prefix
    test, so ``a>b`` never takes ``a>bc``. The rules become a CASE in the plan."""
    closed = F.concat(path, F.lit(">"))
    rules = default_agent_rules() if rules is None else rules
    if not rules:
        return F.lit(default)
    cases = reduce(
        lambda acc, r: acc.when(closed.startswith(r.prefix + ">"), F.lit(r.agent)), rules, F
    )
    return cases.otherwise(F.lit(default))


def glob_regex(glob: str) -> str:
    """Regex for a path glob: ``**/`` any number of folders (also none), ``**``
    anything, ``*`` anything but a slash, ``?`` one character but a slash."""
    out, i = [], 0
    marks = (("**/", "(?:.*/)?"), ("**", ".*"), ("*", "[^/]*"), ("?", "[^/]"))
    while i < len(glob):
        for mark, regex in marks:
            if glob.startswith(mark, i):
                out.append(regex)
                i += len(mark)
                break
        else:
            c = glob[i]
            out.append(c if c.isalnum() or c in "_/" else "\\" + c)
            i += 1
    return "(?s)^" + "".join(out) + "$"
