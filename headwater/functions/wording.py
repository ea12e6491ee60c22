"""The sentences of the daily brief, the weekly report and the check table, in the order they come in."""

BRIEF = {
    "title": "{day} AI 뉴스 브리핑",
    "lead_many": "어제 이 소식을 다룬 매체가 {n}곳으로 가장 많았다.",
    "lead_one": "다룬 매체는 한 곳뿐이지만 어제 나온 소식 가운데 가장 컸다.",
    "link": "링크: {link}",
    "none_with_mean": "어제는 기사가 한 건도 모이지 않았다. 최근 7일 평균이 {mean}건이라 수집이 제대로 돌았는지 봐야 한다.",
    "none": "어제는 기사가 한 건도 모이지 않았다.",
    "count": "어제 모인 기사는 {n}건이다.",
    "no_history": " 견줄 만한 앞선 기록이 아직 없어 최근 평균과는 견주지 않았다.",
    "short_history": " 견줄 만한 앞선 기록이 {days}일뿐이라 최근 평균과는 견주지 않았다.",
    "similar": " 최근 7일 평균 {mean}건과 비슷하다.",
    "more": " 최근 7일 평균 {mean}건보다 {diff}건 많다.",
    "fewer": " 최근 7일 평균 {mean}건보다 {diff}건 적다.",
    "outlets": "매체 {n}곳",
    "new_tool": "새로 나온 도구",
    "cut_many": "어제 나온 소식은 {total}개이고 두 곳 이상이 함께 다룬 소식은 {multi}개였다. 브리핑에는 {shown}개만 올렸다.",
    "cut_single": "어제 나온 소식은 {total}개인데 모두 한 곳에서만 다뤘다. 브리핑에는 {shown}개만 올렸다.",
    "too_few": "올린 묶음이 {shown}개다. 설정에는 {least}개는 되어야 한다고 적어 두었으니 수집이나 판단 쪽을 한 번 보는 편이 좋겠다.",
    "keywords_empty": "앞선 {days}일 기사 기록이 없어 처음 보는 키워드는 비워 두었다.",
    "keywords_cut": "처음 보는 말은 모두 {total}개인데 여기에는 {shown}개만 적었다.",
    "general": "그 밖의 묶음",
    "keywords": "처음 보는 키워드",
    "keywords_why": "최근 7일 기사에는 없다가 어제 처음 올라온 말이다.",
    "policy": "규제와 정책",
    "quiet": "어제는 조용했다. 묶을 만한 소식이 없었다.",
    "quiet_none": "어제는 조용했다. 기사가 한 건도 모이지 않았다.",
    "source": "자료는 GDELT DOC 2.0 에서 받았고 하루 경계는 한국 시간으로 끊었다.",
    "query": " 검색어는 {query} 이다.",
    "read": " 제목과 링크, 매체, 시각만 들어오기 때문에 본문은 읽지 않고 제목만 보고 골랐다.",
    "no_headline": "제목을 옮기지 못한 묶음이다.",
}

REPORT = {
    "title": "주간 AI 뉴스 리포트",
    "period": "대상 기간은 한국 시간으로 {first} 월요일부터 {last} 일요일까지다.",
    "kept_alone": "이번 주에 AI가 남긴 기사는 {n}건이다. 지난주는 수집 기록이 없어 견주지 않는다.",
    "kept": "이번 주에 AI가 남긴 기사는 {n}건, 지난주는 {last}건이다.",
    "rose": " {n}건 늘었다.",
    "fell": " {n}건 줄었다.",
    "same": " 지난주와 같다.",
    "missing": "판단 기록이 없는 날이 {n}일 있다. 빈 날짜는 다음과 같다. {days}",
    "upcoming": "아직 오지 않은 날이 {n}일 있다. 그 날짜는 다음과 같다. {days}",
    "tools": "이번 주에 새로 나온 도구",
    "no_tools": "새 도구 소식으로 묶인 기사가 이번 주에는 없다.",
    "policies": "규제와 정책",
    "no_policies": "규제나 정책으로 묶인 기사가 이번 주에는 없다.",
    "one_link": "대표 링크 {link}",
    "links": "기사 {n}건, 대표 링크 {link}",
    "no_link": "대표 링크가 없다",
    "keywords": "많이 나온 키워드",
    "no_keywords": "이번 주에도 지난주에도 걸린 키워드가 없어서 표를 비워 둔다.",
    "table": ("| 키워드 | 이번 주 | 지난주 | 변화 |", "| --- | ---: | ---: | ---: |"),
    "table_alone": ("| 키워드 | 이번 주 |", "| --- | ---: |"),
    "top": "이번 주에 가장 많이 나온 키워드는 {word}{particle} {n}건이다.",
    "top_rose": " 지난주보다 {n}건 늘었다.",
    "top_fell": " 지난주보다 {n}건 줄었다.",
    "top_same": " 지난주와 건수가 같다.",
    "fresh": "지난주에 없다가 이번 주에 올라온 키워드는 {words}{particle}.",
    "gone": "지난주에 있다가 이번 주에 빠진 키워드는 {words}{particle}.",
    "comments": "사람 코멘트",
    "comments_kept": "아래 인용 블록은 앞서 만든 리포트에 적힌 것을 그대로 옮겼다.",
    "comments_empty": "아래 인용 블록은 비워 둔다. 리포트를 읽고 직접 채운다.",
}

#: The checks' names, in their order.
CHECKS = {
    "count": "수집 건수",
    "windows": "상한 구간",
    "dates": "날짜 범위",
    "fields": "필수 필드",
    "duplicates": "링크 중복",
    "load": "적재 대조",
    "history": "기록 이어짐",
    "volume": "최근 이레 대비",
    "dropped": "걸러낸 비율",
    "judged": "판단 대조",
    "links": "기사 링크 대조",
}
CHECK_TABLE = ("점검", "상태", "내용")
